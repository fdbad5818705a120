"""Operator 9, MinHash near-dedup with odd sketches.

Links are pairs of documents with ``100 * |A & B| >= 75 * |A | B|`` over their
sets of 5-word shingles; the result is their connected components.

1. Per document, from the whole text: the set (64-bit hashes), ``BANDS * ROWS``
   MinHash samples, one key per band, and the odd sketch: every (sample number,
   sample) flips one bit of a ``SKETCH_BITS`` bitmap. Documents with the same
   set form one class (128-bit digest, map-side first); only its smallest id
   goes on, so exact copies never meet in pairs.
2. Band keys that one class alone has are dropped. A key of many classes is
   dealt by hash to blocks; pairs of blocks are separate groups.
3. The population count of two sketches' XOR gives the number of differing
   samples, hence the similarity; pairs that it (or the sizes alone) puts far
   below the limit are no candidates. The bound is wide enough that a true
   link fails it with a chance of about 1e-7.
4. Round one keeps, per group, a spanning forest of the candidates, best
   estimates first, over each block and between the first block and the others:
   linear in the bucket, whatever its size. Its pairs are confirmed on the full
   sets, and the confirmed links joined to components. The forest's own
   components, confirmed or not, are the clusters.
5. Round two finds what round one left open. Inside clusters of several
   components the exact intersections of all pairs come from matrix products
   over the members' shingles, block by block, and only spanning links leave a
   task. Candidates between clusters (rare) are confirmed pair by pair.
   After it every candidate is confirmed, refuted, or inside one component, so
   no link is lost and no task emits the pairs of a group.

A pair at exactly 0.75 shares no band with a chance of (1 - 0.75^4)^40 = 2.4e-7.
Defined results: NULL and empty texts (and texts of white space) have no
shingles and link with nothing; rows with a NULL id link with nothing and are
kept; rows that repeat an id are one node; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.llm.components import components
from featlab.llm.pieces import text_array
from featlab.llm.shared import sized, small_batches, task_count, text_or_empty, tidy, without, written
from featlab.llm.shingles import mixed, shingle_sets

WIDTH = 5
BANDS, ROWS = 40, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
BLOCK = 256
#: Shingles that one matrix product covers.
COLUMNS = 8192
#: Limit as a fraction of integers: link if DEN * intersection >= NUM * union.
NUM, DEN = 75, 100

_RNG = np.random.default_rng(90125)
_MULTIPLY = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_SAMPLE_SALT = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64))


def most_differing_bits(similarity: float = NUM / DEN, deviations: float = 5.2) -> int:
    """XOR population count that a pair at ``similarity`` exceeds with a chance of about 1e-7.

    Of SAMPLES samples d differ (binomial), and each puts two elements into the
    symmetric difference; m thrown elements leave n/2 * (1 - exp(-2m/n)) odd bits."""
    d = SAMPLES * (1 - similarity) + deviations * math.sqrt(SAMPLES * similarity * (1 - similarity))
    odd = SKETCH_BITS / 2 * (1 - math.exp(-2 * (2 * d) / SKETCH_BITS))
    return math.ceil(odd + 2 * math.sqrt(odd))


def min_samples(shingles: np.ndarray) -> np.ndarray:
    """SAMPLES minima of a non-empty set, 32 bits each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(out, (x[k:k + 1024, None] * _MULTIPLY + _ADD).min(axis=0), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (rows of samples of many documents)."""
    groups = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(len(samples), 0)
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + groups[:, :, r])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps, SKETCH_BITS / 8 bytes per row."""
    bit = (mixed(samples.astype(np.uint64) + _SAMPLE_SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    cell = bit + (np.arange(len(samples)) * SKETCH_BITS)[:, None]
    odd = np.bincount(cell.reshape(-1), minlength=len(samples) * SKETCH_BITS).reshape(-1, SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, hashed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, digest`` (of the set; NULL without shingles), ``keys, sketch``, and ``text_sha256`` if ``hashed``."""
    extra = ["text_sha256"] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, samples = [], [], np.zeros((b.num_rows, SAMPLES), np.uint32)
            for k, s in enumerate(shingle_sets(text_array(b.column(1)), width)):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                if len(s):
                    samples[k] = min_samples(s)
            keys, sketch = band_keys(samples), odd_sketches(samples)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1))),
                pa.array([r.tobytes() for r in sketch], pa.binary()), *b.columns[2:]], ["doc_id", "n_shingles", "digest", "keys", "sketch", *extra])
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *[F.sha2(text, 256).alias(c) for c in extra]) \
        .mapInArrow(tidy(run), "doc_id long, n_shingles long, digest binary, keys array<long>, sketch binary" + "".join(f", {c} string" for c in extra))


def _grouped(solve):
    """A mapInArrow function that calls ``solve`` on whole groups; rows arrive sorted by their first column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            g = np.concatenate([x.column(0).to_numpy() for x in held])
            cut = int(np.argmax(g == g[-1])) if len(g) else 0  # the last group may go on in the next batch
            if cut:
                table = pa.Table.from_batches(held)
                yield solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if sum(x.num_rows for x in held):
            yield solve(pa.Table.from_batches(held))
    return run


def _found(a: list, b: list) -> pa.RecordBatch:
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _spanning(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Numbers of the links (x[k], y[k]) that join two parts, in the given order."""
    root: dict[int, int] = {}
    keep = []
    for k, (p, q) in enumerate(zip(x.tolist(), y.tolist())):
        while root.setdefault(p, p) != p:
            root[p] = p = root[root[p]]
        while root.setdefault(q, q) != q:
            root[q] = q = root[root[q]]
        if p != q:
            root[q] = p
            keep.append(k)
    return keep


def _sides(side: np.ndarray, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(side[s:e] != 1) + s, np.flatnonzero(side[s:e] != 0) + s


def _candidates(spanning: bool, most: int):
    """Groups of rows g, side, doc_id, n, part, sketch to candidate pairs.

    side 0/1: the two blocks of a pair, 2: a block with itself. ``spanning``:
    a spanning forest per group; else all candidates of different parts."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        g, side, doc, n, part = (table.column(k).to_numpy() for k in range(5))
        sketch = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        out_a, out_b = [], []
        for s, e in zip(first.tolist(), np.append(first[1:], len(g)).tolist()):
            left, right = _sides(side, s, e)
            if side[s] == 2:
                i, j = np.triu_indices(len(left), 1)
            else:
                i, j = (x.reshape(-1) for x in np.indices((len(left), len(right))))
            p, q = left[i], right[j]
            ok = DEN * np.minimum(n[p], n[q]) >= NUM * np.maximum(n[p], n[q])
            ok &= (doc[p] != doc[q]) if spanning else (part[p] != part[q])
            p, q = p[ok], q[ok]
            apart = np.bitwise_count(sketch[p] ^ sketch[q]).sum(axis=1, dtype=np.int64)
            ok = apart <= most
            p, q, apart = p[ok], q[ok], apart[ok]
            if spanning and len(p) > 1:
                best = np.argsort(apart, kind="stable")
                p, q = p[best], q[best]
                keep = _spanning(p, q)
                p, q = p[keep], q[keep]
            out_a.append(doc[p])
            out_b.append(doc[q])
        return _found(out_a, out_b)
    return _grouped(solve)


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices over the shared members."""
    out = np.zeros((len(left), len(right)))
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    where = [np.minimum(np.searchsorted(common, x), max(len(common) - 1, 0)) for x in (a, b)]
    hit = [common[w] == x if len(common) else np.zeros(len(x), bool) for w, x in zip(where, (a, b))]
    for k in range(0, len(common), COLUMNS):
        m = []
        for r, w, h, x in zip(rows, where, hit, (left, right)):
            now = h & (w >= k) & (w < k + COLUMNS)
            matrix = np.zeros((len(x), min(COLUMNS, len(common) - k)), np.float32)
            matrix[r[now], w[now] - k] = 1
            m.append(matrix)
        out += m[0] @ m[1].T
    return out


def _exact_links(table: pa.Table) -> pa.RecordBatch:
    """Groups of rows g, side, doc_id, comp, shingles to spanning links between components."""
    g, side, doc, comp = (table.column(k).to_numpy() for k in range(4))
    sets = [np.frombuffer(x, np.uint64) for x in table.column(4).to_pylist()]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    out_a, out_b = [], []
    for s, e in zip(first.tolist(), np.append(first[1:], len(g)).tolist()):
        left, right = _sides(side, s, e)
        if not len(left) or not len(right):
            continue
        both = intersections([sets[k] for k in left], [sets[k] for k in right])
        n = np.asarray([len(sets[k]) for k in range(s, e)], np.float64)
        near = DEN * both >= NUM * (n[left - s][:, None] + n[right - s][None] - both)
        i, j = np.nonzero(near & (comp[left][:, None] != comp[right][None]))
        p, q = left[i], right[j]
        keep = _spanning(comp[p], comp[q])
        out_a.append(doc[p[keep]])
        out_b.append(doc[q[keep]])
    return _found(out_a, out_b)


def _faced(rows: DataFrame, key: str, only_first: bool) -> DataFrame:
    """Rows (key, blocks, block, ...) once per pair of blocks they are in: ``g`` and ``side`` (0/1, or 2 for the block itself)."""
    partner = F.sequence(F.lit(0), F.col("blocks") - 1)
    if only_first:  # each block, and the first block with every other
        partner = F.when(F.col("block") == 0, partner).otherwise(F.array(F.lit(0), F.col("block")))
    rows = rows.withColumn("other", F.explode(partner))
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).cast("long")
    return rows.withColumn("g", F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other"))).withColumn("side", side)


def _blocked(rows: DataFrame) -> DataFrame:
    """``blocks`` of a group of n rows, and the ``block`` of each row by its id's hash."""
    return rows.withColumn("blocks", F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)")) \
        .withColumn("block", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))


def _pairs(slots: DataFrame, prints: DataFrame, spanning: bool, most: int) -> DataFrame:
    """Candidate pairs (a < b) of the buckets ``slots`` (key, doc_id, blocks, block)."""
    faced = _faced(slots, "key", only_first=spanning).select("doc_id", "g", "side").join(prints, "doc_id") \
        .select("g", "side", "doc_id", "n_shingles", "part", "sketch")
    return faced.repartition(task_count(slots.sparkSession), "g").sortWithinPartitions("g", "side") \
        .mapInArrow(tidy(_candidates(spanning, most)), "a long, b long").distinct()


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``doc_id, shingles`` (64-bit hashes in one binary) of the documents in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for s in shingle_sets(text_array(b.column(1)), width)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return texts.join(sized(ids), "doc_id", "left_semi").mapInArrow(tidy(run), "doc_id long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, by their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(DEN * both >= NUM * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, hashed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row, with ``text_sha256`` if ``hashed``."""
    extra = ["text_sha256"] if hashed else []
    small_batches(docs.sparkSession)
    most = most_differing_bits()
    prints = written(fingerprints(docs, id_col, text_col, width, hashed), "fingerprints")
    usable = prints.filter("digest is not null and doc_id is not null")
    copies = written(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).filter("n > 1").select("digest", "rep"), "near-copies")
    marked = usable.join(sized(copies), "digest", "left")
    reps = written(marked.filter("rep is null").unionAll(marked.filter("doc_id = rep").dropDuplicates(["digest"])).drop("rep"), "near-classes")
    slots = reps.select("doc_id", F.explode("keys").alias("key"))
    shared = slots.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    slots = written(_blocked(slots.join(shared, "key")).select("key", "doc_id", "blocks", "block"), "near-buckets")
    light = reps.select("doc_id", "n_shingles", "sketch")

    first = written(_pairs(slots, light.withColumn("part", F.col("doc_id")), True, most), "near-pairs")
    ids = written(first.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "near-ids")
    sets = written(_sets(docs, ids, id_col, text_col, width), "near-sets")
    links = written(_confirmed(first, sets), "near-links")
    comps = written(components(links).withColumnsRenamed({"node": "doc_id", "component": "comp"}), "near-components")
    clusters = written(components(first).withColumnsRenamed({"node": "doc_id", "component": "cluster"}), "near-clusters")

    members = clusters.join(comps, "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    several = written(members.groupBy("cluster").agg(F.count("*").alias("n"), F.min("comp").alias("x"), F.max("comp").alias("y"))
                      .filter("x <> y").select("cluster", "n"), "near-several")
    inside = _faced(_blocked(members.join(sized(several), "cluster")), "cluster", only_first=False) \
        .select("g", "side", "doc_id", "comp").join(sets, "doc_id").select("g", "side", "doc_id", "comp", "shingles") \
        .repartition(task_count(docs.sparkSession), "g").sortWithinPartitions("g", "side").mapInArrow(tidy(_grouped(_exact_links)), "a long, b long")
    parts = light.join(clusters, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("cluster", "doc_id").alias("part"), "sketch")
    across = written(_pairs(slots, parts, False, most), "near-pairs")
    more = written(across.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().join(ids, "doc_id", "left_anti"), "near-ids")
    if not more.isEmpty():
        sets = sets.unionByName(_sets(docs, more, id_col, text_col, width))
    links = links.unionByName(inside).unionByName(_confirmed(across, sets))
    comps = written(components(links), "near-components")

    found = marked.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"), *extra)
    linked = found.join(sized(comps), found["rep"] == comps["node"], "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), *extra)
    alone = prints.filter("digest is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *extra)
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document (the smallest id) of each component. Rows go
    by id and text, so another text under a dropped copy's id stays."""
    dropped = near_duplicates(docs, id_col, text_col, hashed=True).filter("not kept").select("doc_id", "text_sha256").distinct()
    return without(docs, id_col, dropped, "near-dropped", F.sha2(text_or_empty(text_col), 256))
