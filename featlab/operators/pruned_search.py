"""Exact top-k cosine search that skips what cannot be near.

1. Some vectors (``PIVOTS`` at most) are pivots: of a bounded sample taken by a hash
   of the id, each time the one farthest from the pivots so far. Every vector
   belongs to its nearest pivot and, by its angle to it, to one of ``RINGS`` rings;
   such a cell keeps the smallest and largest angle of its members to the pivot.
2. Cells are cut into blocks of bounded bytes, so a cell that holds a third of
   all vectors (copies, say) is many tasks. Inside its own block each vector
   gets its k-th best similarity: a lower bound of the final one.
3. Angles obey the triangle inequality: a member of a cell whose angles lie in
   [low, high] is at least max(angle - high, low - angle, 0) away from a vector at
   ``angle`` from the pivot. A cell whose best possible similarity is below the
   bound of every vector of a block is not sent to that block.
4. Each block ranks its vectors against the blocks that are left, streamed from their
   files through the same running top-k as in ``vectors.topk_similar``. The blocks are
   written once; no vector is sent to a block that has to see it.

The result is that of the plain search, ties included. What reaches the driver:
the sample and one row per cell, bounded by ``PIVOTS`` x ``SAMPLE`` and ``PIVOTS`` x
``RINGS`` rows whatever the table. Vectors of length zero
have similarity 0 with everything and obey no triangle inequality: they form a cell
of their own, which others must visit only where similarity 0 can still count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.operators.vectors import TOPK_ROWS, arrays_of, get_block, put_block, topk_of_block, unit_vectors, vector_folder
from featlab.session import written_table
from featlab.sources.shared_files import open_folder

#: Pivots at most, vectors a pivot should have at least, sampled vectors a pivot, rings of angle a pivot.
PIVOTS, CELL_ROWS, SAMPLE, RINGS = 256, 64, 16, 16
#: Slack in radians for rounded angles.
SLACK = 1e-6


def _spread(x: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` different rows of ``x``, each the farthest from those before it."""
    picked, near = [0], x @ x[0]
    while len(picked) < wanted and near.min() < 1 - 1e-9:
        picked.append(int(near.argmin()))
        near = np.maximum(near, x @ x[picked[-1]])
    return x[picked]


def _cells(pivots: np.ndarray):
    """Task adding ``cell`` (nearest pivot x ``RINGS`` + ring, or one number more for vectors without direction) and ``angle``."""
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
            sim = np.clip(x @ pivots.T, -1.0, 1.0)
            cell = sim.argmax(axis=1)
            angle = np.arccos(sim[np.arange(len(x)), cell])
            cell = cell * RINGS + np.minimum((angle * (RINGS / np.pi)).astype(np.int64), RINGS - 1)
            odd = ~(np.abs(np.linalg.norm(x, axis=1) - 1.0) < 1e-6)
            cell[odd], angle[odd] = len(pivots) * RINGS, 0.0
            yield pdf.assign(cell=cell.astype("int32"), angle=angle)
    return run


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Task over ``qb, id, vec`` rows sorted by block: the block files."""
    now, ids, vecs = None, [], []
    for b in batches:
        if not b.num_rows:
            continue
        keys, (i, x) = b.column(0).to_numpy(), arrays_of(b, 1, 2)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for at, to in zip(cuts, cuts[1:]):
            if keys[at] != now and ids:
                put_block(folder, now, ids, vecs)
                ids, vecs = [], []
            now = int(keys[at])
            ids.append(i[at:to])
            vecs.append(x[at:to])
    if ids:
        put_block(folder, now, ids, vecs)
    yield from ()


def _visits(folder: str, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, k: int, exclude_self: bool):
    """Function from a block to the cells that some vector of it has to see; ``first``: the first block of each cell."""
    odd_cell = len(pivots) * RINGS
    pivot_of = np.arange(odd_cell) // RINGS

    def cells_of(block: int) -> np.ndarray:
        if np.searchsorted(first, block, "right") - 1 == odd_cell:
            return np.arange(odd_cell + 1)
        x = get_block(folder, block)[1]
        own = x @ x.T
        if exclude_self:
            np.fill_diagonal(own, -np.inf)
        bound = np.partition(own, len(own) - k, axis=1)[:, len(own) - k] if len(own) >= k else np.full(len(own), -np.inf)
        angle = np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))[:, pivot_of]
        away = np.maximum(np.maximum(angle - high, low - angle) - SLACK, 0.0)
        seen = (np.cos(np.minimum(away, np.pi)) >= bound[:, None] - SLACK * SLACK).any(axis=0)
        return np.append(np.flatnonzero(seen), [odd_cell] if (bound <= SLACK).any() else []).astype(np.int64)
    return cells_of


def _cell_files(df: DataFrame, id_col: str, vec_col: str, k: int, block_bytes: int, exclude_self: bool):
    """Steps 1 to 3: (folder of the block files, first block of each cell and their number at the end, function from
    a block to the cells it has to see), or None for a table without vectors."""
    spark = df.sparkSession
    vecs = unit_vectors(df, id_col, vec_col)
    size = vecs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not size.n:
        return None
    wanted = min(PIVOTS, max(1, size.n // CELL_ROWS))
    square = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
    chosen = vecs.filter(F.abs(square - 1) < 1e-6).orderBy(F.xxhash64("id"), "id").limit(wanted * SAMPLE).collect()   # PIVOTS x SAMPLE rows at most
    pivots = _spread(np.array([r.vec for r in chosen], dtype=np.float64), wanted) if chosen else np.eye(1, size.d)
    placed = written_table(vecs.mapInPandas(_cells(pivots), "id bigint, vec array<double>, cell int, angle double"))
    stats = {r.cell: r for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).collect()}
    rows = max(1, block_bytes // (8 * size.d))
    parts = np.array([-(-stats[c].n // rows) if c in stats else 0 for c in range(len(pivots) * RINGS + 1)])
    first = np.concatenate([[0], np.cumsum(parts)])
    table = [(c, int(first[c]), int(parts[c])) for c in sorted(stats)]
    cells = F.broadcast(spark.createDataFrame(table, "cell int, first bigint, parts bigint"))   # PIVOTS x RINGS + 1 rows at most
    block = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).alias("qb")
    low = np.array([stats[c].low if c in stats else np.pi for c in range(len(pivots) * RINGS)])
    high = np.array([stats[c].high if c in stats else -np.pi for c in range(len(pivots) * RINGS)])   # empty cells are never near
    folder = vector_folder(df)
    placed.join(cells, "cell").select(block, "id", "vec").repartition(_tasks(spark, int(first[-1])), "qb").sortWithinPartitions("qb", "id") \
        .mapInArrow(lambda batches: _write(batches, folder), "done int").write.format("noop").mode("overwrite").save()
    return folder, first, _visits(folder, pivots, low, high, first[:-1], k, exclude_self)


def _existing(folder: str, blocks: Iterable[int]) -> Iterator[int]:
    """The blocks that hold vectors: the hash of the ids may leave one empty."""
    there = _listed(folder)
    return (b for b in blocks if b in there)


@lru_cache(maxsize=2)
def _listed(folder: str) -> frozenset[int]:
    files, path = open_folder(folder)
    return frozenset(int(x.base_name) for x in files.get_file_info(fs.FileSelector(path)) if x.base_name.isdigit())


def _tasks(spark, blocks: int) -> int:
    return max(1, min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")) * 8))


def _blocks_of(cells: np.ndarray, first: np.ndarray) -> Iterator[int]:
    for c in cells.tolist():
        yield from range(int(first[c]), int(first[c + 1]))


def cell_visits(df: DataFrame, id_col: str, vec_col: str, k: int, block_bytes: int, exclude_self: bool = True):
    """Steps 1 to 3 as tables: ``(block numbers, blocks with their cell, (qb, cell) visits, number of blocks)``, or None for a
    table without vectors."""
    found = _cell_files(df, id_col, vec_col, k, block_bytes, exclude_self)
    if found is None:
        return None
    spark, (folder, first, cells_of) = df.sparkSession, found
    n = int(first[-1])
    numbers = spark.range(n).select(F.col("id").alias("qb"))
    blocks = spark.createDataFrame([(c, int(a), int(b)) for c, (a, b) in enumerate(zip(first, first[1:])) if b > a], "cell int, a bigint, b bigint") \
        .select("cell", F.explode(F.sequence("a", F.col("b") - 1)).alias("cb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in _existing(folder, b.column(0).to_pylist()):
                cells = cells_of(block)
                yield pa.RecordBatch.from_pydict({"qb": pa.array(np.full(len(cells), block)), "cell": pa.array(cells.astype(np.int32))})
    return numbers, blocks, numbers.repartition(_tasks(spark, n)).mapInArrow(run, "qb bigint, cell int"), n


def topk_pruned(df: DataFrame, id_col: str, vec_col: str, k: int = 8, block_bytes: int = 1 << 20, exclude_self: bool = True) -> DataFrame:
    """J07/R02 with pruning: ``query_id, rank, other_id, sim`` as
    ``vectors.topk_similar`` gives them. A block reads the blocks that it may need
    from their files. NULL and empty vectors are left out."""
    spark = df.sparkSession
    found = _cell_files(df, id_col, vec_col, k, block_bytes, exclude_self)
    if found is None:
        return spark.createDataFrame([], TOPK_ROWS)
    folder, first, cells_of = found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in _existing(folder, b.column(0).to_pylist()):
                best = topk_of_block(folder, block, _existing(folder, _blocks_of(cells_of(block), first)), k, exclude_self)
                if best is not None:
                    yield from best.to_batches(max_chunksize=50_000)
    n = int(first[-1])
    return spark.range(n).repartition(_tasks(spark, n)).mapInArrow(run, TOPK_ROWS)
