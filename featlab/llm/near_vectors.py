"""Operator 2, embedding near-dedup: random-hyperplane signs in several tables, exact cosine, components.

1. Identical vectors of a label become one class with a size (grouping compares
   the vectors themselves, map-side first), so exact copies cost nothing later.
2. Every class gets ``tables`` keys of ``bits`` hyperplane signs. At the limit
   cosine a pair agrees in one key with p = (1 - acos(c)/pi)^bits; the number
   of tables keeps the chance to miss such a pair below ``MISS``.
3. Keys that only one class has are dropped before vectors are moved. A key of
   many classes is dealt, by hash, to blocks of about ``BLOCK`` classes, and
   pairs of blocks are separate groups: no task sees a whole hot bucket.
4. Inside a block pair the cosines are exact, in double precision (a matrix
   product). A pair counts only in the first table where its keys agree, so
   it counts once; only per-class link counts and a spanning set of links leave
   the task, never the pairs.
5. ``components`` joins the spanning links.

Defined results: rows whose vector is NULL, zero, or holds NULL or non-finite
components, whose label is NULL or whose id is NULL link with nothing; vectors
of different lengths never link; repeated ids are vectors of their own under
one name; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.llm.components import components
from featlab.llm.shared import task_count, tidy, written

BITS = 14
MISS = 1e-8
BLOCK = 256
SEED = 20240607
#: Pairs of small groups that are compared at a time.
PAIRS = 40_000


def table_count(cosine: float, bits: int = BITS, miss: float = MISS) -> int:
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log1p(-agree))


@functools.lru_cache(maxsize=4)
def hyperplanes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, count))


def _matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat values as doubles, start, length) of a list column."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    return np.asarray(lists.values).astype(np.float64), offsets[:-1], np.diff(offsets)


def _with_keys(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            flat, starts, dims = _matrix(b.column(4))
            out = np.zeros((b.num_rows, tables), np.int32)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = flat[starts[rows][:, None] + np.arange(dim)]
                signs = (x @ hyperplanes(int(dim), bits * tables) >= 0).reshape(len(rows), tables, bits)
                out[rows] = signs @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * tables), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "keys"])
    return classes.mapInArrow(tidy(keys), "cid long, rep long, size long, label string, vec array<double>, keys array<int>")


class _Links:
    """Counted links of one task: weights per class, and spanning links by union-find."""

    def __init__(self):
        self.cid: list[np.ndarray] = []
        self.weight: list[np.ndarray] = []
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def add(self, p: np.ndarray, q: np.ndarray, cid: np.ndarray, size: np.ndarray, rep: np.ndarray) -> None:
        """Links between rows ``p[k]`` and ``q[k]``."""
        if not len(p):
            return
        self.cid += [cid[p], cid[q]]
        self.weight += [size[q], size[p]]
        # drop links whose ends are already joined inside this task's rows
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x
        keep = []
        for k, (x, y) in enumerate(zip(p.tolist(), q.tolist())):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                keep.append(k)
        self.a.append(rep[p[keep]])
        self.b.append(rep[q[keep]])

    def batch(self) -> pa.RecordBatch:
        cid = np.concatenate([np.zeros(0, np.int64), *self.cid])
        cid, inverse = np.unique(cid, return_inverse=True)
        n = np.bincount(inverse, np.concatenate([np.zeros(0), *self.weight]), len(cid)).astype(np.int64) if len(cid) else cid
        a, b = np.concatenate([np.zeros(0, np.int64), *self.a]), np.concatenate([np.zeros(0, np.int64), *self.b])
        pad = lambda v, before, after: pa.concat_arrays([pa.nulls(before, pa.int64()), pa.array(v, pa.int64()), pa.nulls(after, pa.int64())])
        return pa.RecordBatch.from_arrays([pad(cid, 0, len(a)), pad(n, 0, len(a)), pad(a, len(cid), 0), pad(b, len(cid), 0)], ["cid", "n", "a", "b"])


def _compare(cosine: float):
    """Groups arrive whole and sorted: (g, side) rows; side 0/1 are the two blocks, 2 a block with itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            table = pa.Table.from_batches(held)
            if table.num_rows < 4096:
                continue
            g = table.column(0).to_numpy()
            cut = int(np.searchsorted(g == g[-1], True)) if g[0] != g[-1] else 0
            if cut:
                yield solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    def solve(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        g, side, t, cid, rep, size = (table.column(k).to_numpy() for k in range(6))
        vecs, keys = (table.column(k).combine_chunks() for k in (6, 7))
        vecs, keys = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (vecs, keys))
        flat, starts, dims = _matrix(vecs)
        kflat, kstarts, klen = _matrix(keys)
        kmat = kflat[kstarts[:, None] + np.arange(klen[0] if len(klen) else 0)].astype(np.int32)
        links = _Links()
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        ends = np.append(first[1:], len(g))

        def count(p: np.ndarray, q: np.ndarray, table_no: np.ndarray) -> None:
            same = kmat[p] == kmat[q]
            now = same.argmax(axis=1) == table_no
            links.add(p[now], q[now], cid, size, rep)

        small_p, small_q = [], []
        for s, e in zip(first.tolist(), ends.tolist()):
            if e - s <= 32:
                i, j = np.triu_indices(e - s, 1)
                small_p.append(i + s)
                small_q.append(j + s)
                continue
            dim = dims[s]
            x = flat[starts[s:e][:, None] + np.arange(dim)]
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            left, right = np.flatnonzero(side[s:e] != 1), np.flatnonzero(side[s:e] != 0)
            near = x[left] @ x[right].T >= cosine
            p, q = np.nonzero(near)
            p, q = left[p] + s, right[q] + s
            if side[s] == 2:
                p, q = p[p < q], q[p < q]
            for k in range(0, len(p), PAIRS):
                count(p[k:k + PAIRS], q[k:k + PAIRS], t[s])
        p = np.concatenate([np.zeros(0, np.int64), *small_p])
        q = np.concatenate([np.zeros(0, np.int64), *small_q])
        across = (side[p] == 2) | (side[p] != side[q])
        p, q = p[across], q[across]
        for k in range(0, len(p), PAIRS):
            a, b = p[k:k + PAIRS], q[k:k + PAIRS]
            for dim in np.unique(dims[a]):
                m = dims[a] == dim
                x, y = flat[starts[a[m]][:, None] + np.arange(dim)], flat[starts[b[m]][:, None] + np.arange(dim)]
                c = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                near = c >= cosine
                count(a[m][near], b[m][near], t[a[m][near]])
        return links.batch()
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.98, bits: int = BITS, id_col: str = "vec_id",
                 vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept, class_size`` for every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          F.col(label_col).cast("string").alias("label"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    classes = rows.filter("usable").groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), "rep", "size", "label", "vec"), "vector-classes")
    keyed = written(_with_keys(classes, bits, table_count(cosine, bits)), "vector-keys")

    # buckets: only keys that several classes share
    bucket = ["label", "dim", "t", "key"]
    slots = keyed.select("cid", "label", F.size("vec").alias("dim"), F.posexplode("keys").alias("t", "key"))
    shared = slots.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1")
    slots = slots.join(shared, bucket).withColumn("blocks", F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)")) \
        .withColumn("block", F.expr("cast(pmod(xxhash64(cid), blocks) as int)")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    # rows of an own-block group are marked 2; in a pair of blocks 0 and 1 face each other
    slots = slots.select("cid", F.col("t").cast("long").alias("t"), side.cast("long").alias("side"),
                         F.struct(*bucket, low.alias("low"), high.alias("high")).alias("group"))
    n = task_count(vectors.sparkSession)
    placed = slots.join(keyed.select("cid", "rep", "size", "vec", "keys"), "cid") \
        .repartition(n, "group").sortWithinPartitions("group", "side") \
        .withColumn("g", F.xxhash64("group"))
    found = written(placed.select("g", "side", "t", "cid", "rep", "size", "vec", "keys")
                    .mapInArrow(tidy(_compare(cosine)), "cid long, n long, a long, b long"), "vector-links")

    counts = found.filter("cid is not null").groupBy("cid").agg(F.sum("n").alias("n"))
    comps = components(found.filter("a is not null").select("a", "b"))
    per_class = classes.join(counts, "cid", "left").join(comps, classes["rep"] == comps["node"], "left") \
        .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"), "size")
    linked = rows.filter("usable").join(per_class, ["label", "vec"]) \
        .select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"), F.col("size").alias("class_size"))
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                             F.lit(True).alias("kept"), F.lit(1).cast("long").alias("class_size"))
    return linked.unionAll(alone)


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept, 1::BIGINT AS class_size
FROM c LEFT JOIN n USING (vec_id)
"""
