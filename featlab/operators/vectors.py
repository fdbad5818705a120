"""Vector similarity and embedding lookups.

Exact top-k cosine search (J07) without emitting pairs as rows and without
a group that grows with the data:

* vectors are L2-normalised and written once to the shared folder, in block files
  of about ``block_bytes``;
* a task opens one block of queries after the other and streams the other blocks
  past it from their files, keeping a running top-k per query from numpy matrix
  products of bounded size. No vector is shuffled or written again per query
  block: the disk holds the vectors once, whatever their number.

Work is the inherent n^2 d of exact search, spread over the blocks; output is
exactly k rows per query (fewer if there are fewer vectors). NULL and empty
vectors and vectors without an id are neither queries nor candidates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.functions.arrays import l2_normalize, to_double_array
from featlab.session import ensure_checkpoint_dir
from featlab.sources.shared_files import get_array, put

#: Query rows of one matrix product, candidate rows of one, weight rows that are at most sent to all tasks.
PRODUCT_ROWS, CANDIDATE_ROWS, BROADCAST_ROWS = 512, 4096, 10_000
#: Blocks that a task writes are numbered below its attempt's number.
BLOCKS_A_TASK = 1 << 20
TOPK_ROWS = "query_id bigint, rank int, other_id bigint, sim double"


def _merged(best_s: np.ndarray, best_i: np.ndarray, s: np.ndarray, cid: np.ndarray, k: int, width: int):
    """The first ``width`` of the best so far and the candidates, per row: similarity down, id up. Only candidates that
    reach the row's k-th best so far (or, before there are k, the k-th best of the candidates) are sorted."""
    if best_s.shape[1] >= k:
        bound = best_s[:, k - 1]
    elif s.shape[1] > k:
        bound = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    else:
        bound = np.full(len(s), -np.inf)
    row, at = np.nonzero(s >= bound[:, None])
    have = best_s.shape[1]
    rows = np.concatenate([np.repeat(np.arange(len(s)), have), row])
    sims, ids = np.concatenate([best_s.ravel(), s[row, at]]), np.concatenate([best_i.ravel(), cid[at]])
    order = np.lexsort((ids, -sims, rows))
    rows, sims, ids = rows[order], sims[order], ids[order]
    first = np.searchsorted(rows, np.arange(len(s)))
    take = np.arange(len(rows)) - first[rows] < width
    return sims[take].reshape(len(s), width), ids[take].reshape(len(s), width)


# ---- block files ---------------------------------------------------------------------------
def unit_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (length 1, or 0) of the rows with an id and a vector."""
    return df.filter((F.size(F.col(vec_col)) > 0) & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("bigint").alias("id"), l2_normalize(to_double_array(F.col(vec_col))).alias("vec"))


def vector_folder(df: DataFrame) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/vectors-{uuid.uuid4().hex}"


def arrays_of(batch: pa.RecordBatch, ids: int = 0, vecs: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(ids, n x d numbers) of a batch's columns."""
    size = pc.list_value_length(batch.column(vecs)).to_numpy(zero_copy_only=False)
    if (size != size[0]).any():
        raise ValueError("vectors differ in length")
    return batch.column(ids).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(vecs).flatten().to_numpy(zero_copy_only=False).reshape(len(size), -1)


def put_block(folder: str, number: int, ids: list[np.ndarray], vecs: list[np.ndarray]) -> None:
    put(folder, str(number), [np.array([sum(map(len, ids)), vecs[0].shape[1]]).tobytes(), *[x.tobytes() for x in ids], *[np.ascontiguousarray(x, float).tobytes() for x in vecs]], str(TaskContext.get().taskAttemptId()))


def get_block(folder: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, n x d numbers) of a block file."""
    raw = get_array(folder, str(number), np.int64)
    n, d = raw[:2].tolist()
    return raw[2:2 + n], raw[2 + n:].view(np.float64).reshape(n, d)


def write_blocks(vecs: DataFrame, folder: str, block_bytes: int) -> DataFrame:
    """Writes ``id, vec`` rows as block files of about ``block_bytes``; ``block, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a repeated attempt writes files of its own: rows may reach it in another order
        number, ids, held, rows = TaskContext.get().taskAttemptId() * BLOCKS_A_TASK, [], [], 0

        def block() -> pa.RecordBatch:
            put_block(folder, number, ids, held)
            return pa.RecordBatch.from_pydict({"block": pa.array([number]), "n": pa.array([rows])})
        for b in batches:
            if not b.num_rows:
                continue
            i, x = arrays_of(b)
            most, at = max(1, block_bytes // (8 * x.shape[1])), 0
            while at < len(i):
                to = min(len(i), at + most - rows)
                ids.append(i[at:to])
                held.append(x[at:to])
                rows, at = rows + to - at, to
                if rows >= most:
                    yield block()
                    number, ids, held, rows = number + 1, [], [], 0
        if rows:
            yield block()
    return vecs.mapInArrow(run, "block long, n long")


def topk_of_block(folder: str, block: int, others: Iterable[int], k: int, exclude_self: bool) -> pa.Table | None:
    """The ``k`` best of the blocks ``others`` for every vector of ``block``."""
    ids, queries = get_block(folder, block)
    best_s, best_i = np.full((len(ids), 0), -np.inf), np.zeros((len(ids), 0), np.int64)

    def seen(cid: np.ndarray, c: np.ndarray) -> None:
        nonlocal best_s, best_i
        width = min(k, best_s.shape[1] + len(cid))
        new_s, new_i = np.empty((len(ids), width)), np.empty((len(ids), width), np.int64)
        for a in range(0, len(ids), PRODUCT_ROWS):
            part = slice(a, a + PRODUCT_ROWS)
            s = np.fmax(queries[part] @ c.T, -np.inf)   # not a number: last
            if exclude_self:
                s[ids[part, None] == cid[None, :]] = -np.inf
            new_s[part], new_i[part] = _merged(best_s[part], best_i[part], s, cid, k, width)
        best_s, best_i = new_s, new_i
    held, rows = [], 0
    for other in others:
        held.append(get_block(folder, other))
        rows += len(held[-1][0])
        if rows >= CANDIDATE_ROWS:
            seen(*map(np.concatenate, zip(*held)))
            held, rows = [], 0
    if held:
        seen(*map(np.concatenate, zip(*held)))
    good = np.isfinite(best_s).ravel()
    if not good.any():
        return None
    return pa.table({"query_id": np.repeat(ids, best_s.shape[1])[good], "rank": np.tile(np.arange(1, best_s.shape[1] + 1, dtype=np.int32), len(ids))[good],
                     "other_id": best_i.ravel()[good], "sim": best_s.ravel()[good]})


def topk_of_blocks(blocks: DataFrame, folder: str, others: Callable[[int], Iterable[int]], k: int, exclude_self: bool) -> DataFrame:
    """``topk_of_block`` of the ``block`` numbers in ``blocks``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.column(0).to_pylist():
                found = topk_of_block(folder, block, others(block), k, exclude_self)
                if found is not None:
                    yield from found.to_batches(max_chunksize=50_000)
    return blocks.select("block").mapInArrow(run, TOPK_ROWS)


def topk_similar(df: DataFrame, id_col: str, vec_col: str, k: int = 8, block_bytes: int = 1 << 20,
                 exclude_self: bool = True) -> DataFrame:
    """For every vector, the k most cosine-similar other vectors
    (``query_id, rank, other_id, sim``; ties by the smaller id)."""
    spark, folder = df.sparkSession, vector_folder(df)
    found = write_blocks(unit_vectors(df, id_col, vec_col), folder, block_bytes).collect()   # one row per block of ``block_bytes``
    every = sorted(r["block"] for r in found)
    tasks = max(1, min(len(every), 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return topk_of_blocks(spark.createDataFrame([(x,) for x in every], "block long").repartition(tasks), folder, lambda block: every, k, exclude_self)


def embedding_lookup(index_df: DataFrame, weights: DataFrame, idx_col: str = "idx",
                     value_col: str = "value", vec_col: str = "vec") -> DataFrame:
    """Rows of a weight table for an index list, scaled by the value.
    ``index_df`` is long form (sample, field, idx, value); the weight table
    is joined on idx (AQE chooses broadcast when it is small)."""
    return (index_df.join(weights.select(F.col(idx_col), F.col(vec_col)), idx_col)
            .withColumn("scaled", F.transform(vec_col, lambda x: x * F.col(value_col))))


def fm_second_order(index_df: DataFrame, weights: DataFrame, sample_col: str, k: int) -> DataFrame:
    """0.5 * sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2] per sample,
    from the embedding lookup; the sums of all ``k`` factors are columns of one
    aggregation. A few ``weights`` are sent to all tasks, so an index that every
    sample holds is no hot key."""
    few = weights.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    looked = embedding_lookup(index_df, F.broadcast(weights) if few else weights).filter(F.size("scaled") > 0)
    place = [F.get(F.col("scaled"), F.lit(f)) for f in range(k)]
    per = looked.groupBy(sample_col).agg(*[F.sum(p).alias(f"_fl_s{f}") for f, p in enumerate(place)],
                                         *[F.sum(p * p).alias(f"_fl_q{f}") for f, p in enumerate(place)])
    known = F.array_compact(F.array(*[F.col(f"_fl_s{f}") * F.col(f"_fl_s{f}") - F.col(f"_fl_q{f}") for f in range(k)]))
    total = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x))
    return per.select(sample_col, (0.5 * total).alias("fm2"))
