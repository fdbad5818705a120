"""Matrices as coordinate tables ``(i, j, v)`` or tables of blocks.

A product works on dense blocks of at most ``BLOCK`` x ``BLOCK`` numbers: blocks
are joined on the inner index, multiplied by numpy inside the tasks, added up
there and only the sums are shuffled; nothing is densified on the driver.
Factorizations of tall matrices go through a tree of QR factorizations: every
task reduces its rows to one triangular factor, and factors are merged in
groups until one is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.session import reliable_checkpoint

#: Rows and columns of a block (512 KB of doubles).
BLOCK = 256
#: Sums of products a task holds before it hands them over, and blocks of one side that meet in one join group.
HELD_SUMS = 64
GROUP_BLOCKS = 32
#: Triangular factors merged by one task of the tree.
FAN_IN = 16


def from_arrays(df: DataFrame, row_col: str, vec_col: str) -> DataFrame:
    """(row, array) rows -> coordinate table (i, j, v)."""
    return (df.select(F.col(row_col).alias("i"), F.posexplode(vec_col).alias("j", "v"))
            .withColumn("v", F.col("v").cast("double")).withColumn("j", F.col("j").cast("bigint")))


def transpose(m: DataFrame) -> DataFrame:
    """L02."""
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def blocks(m: DataFrame, size: int = BLOCK) -> DataFrame:
    """Coordinates as dense blocks ``bi, bj, rows, cols, data`` (little-endian doubles, row by row);
    ``rows, cols`` are as large as the block's entries ask for. Entries of one place are added."""
    cells = m.filter(F.col("v").isNotNull()).groupBy("i", "j").agg(F.sum("v").alias("v")) \
        .select(F.expr(f"i div {size}").alias("bi"), F.expr(f"j div {size}").alias("bj"), (F.col("i") % size).cast("int").alias("i"),
                (F.col("j") % size).cast("int").alias("j"), F.col("v").cast("double").alias("v"))
    # at most size x size entries a group
    grouped = cells.groupBy("bi", "bj").agg(F.collect_list("i").alias("i"), F.collect_list("j").alias("j"), F.collect_list("v").alias("v"))

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                i, j, v = (b.column(c)[k].values.to_numpy() for c in (2, 3, 4))
                out = np.zeros((i.max() + 1, j.max() + 1))
                out[i, j] = v
                yield _block(b.column(0)[k].as_py(), b.column(1)[k].as_py(), out)
    return grouped.mapInArrow(dense, BLOCKS)


BLOCKS = "bi long, bj long, rows int, cols int, data binary"


def _block(bi: int, bj: int, x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bi": pa.array([bi], pa.int64()), "bj": pa.array([bj], pa.int64()), "rows": pa.array([x.shape[0]], pa.int32()),
                                       "cols": pa.array([x.shape[1]], pa.int32()), "data": pa.array([np.ascontiguousarray(x, "<f8").tobytes()], pa.binary())})


def _matrix(rows: int, cols: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(rows, cols)


def _padded_sum(x: np.ndarray | None, y: np.ndarray) -> np.ndarray:
    """The sum of two blocks that may lack last rows or columns."""
    if x is None or x.shape == y.shape:
        return y if x is None else x + y
    out = np.zeros(np.maximum(x.shape, y.shape))
    out[:x.shape[0], :x.shape[1]] += x
    out[:y.shape[0], :y.shape[1]] += y
    return out


def blocks_product(a: DataFrame, b: DataFrame, transpose_a: bool = False, transpose_b: bool = False) -> DataFrame:
    """op(A) op(B) of block tables (of one block size), as blocks. An inner index with many blocks of A is
    split into groups of ``GROUP_BLOCKS``, each with its own copy of B's blocks, so no index is one task."""
    row, inner = ("bj", "bi") if transpose_a else ("bi", "bj")
    left = a.select(F.col(row).alias("bi"), F.col(inner).alias("bk"), F.struct("rows", "cols", "data").alias("a"))
    row, inner = ("bj", "bi") if transpose_b else ("bi", "bj")
    right = b.select(F.col(row).alias("bk"), F.col(inner).alias("bj"), F.struct("rows", "cols", "data").alias("b"))
    groups = left.groupBy("bk").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCKS).cast("long").alias("g"))
    left = left.join(groups, "bk").withColumn("s", F.pmod(F.xxhash64("bi"), "g"))
    right = right.join(groups, "bk").withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)))
    pairs = left.drop("g").join(right.drop("g"), ["bk", "s"]).select("bi", "bj", "a.rows", "a.cols", "a.data", "b.rows", "b.cols", "b.data") \
        .toDF("bi", "bj", "ar", "ac", "ad", "br", "bc", "bd")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for bi, bj, ar, ac, ad, br, bc, bd in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = _matrix(ar, ac, ad), _matrix(br, bc, bd)
                x, y = x.T if transpose_a else x, y.T if transpose_b else y
                n = min(x.shape[1], y.shape[0])
                held[bi, bj] = _padded_sum(held.get((bi, bj)), x[:, :n] @ y[:n])
                if len(held) > HELD_SUMS:
                    for (i, j), v in held.items():
                        yield _block(i, j, v)
                    held = {}
        for (i, j), v in held.items():
            yield _block(i, j, v)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for bi, bj, r, c, d in zip(*(x.to_pylist() for x in batch.columns)):
                if (bi, bj) != at:
                    if at is not None:
                        yield _block(*at, total)
                    at, total = (bi, bj), None
                total = _padded_sum(total, _matrix(r, c, d))
        if at is not None:
            yield _block(*at, total)
    return pairs.mapInArrow(multiply, BLOCKS).repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInArrow(add, BLOCKS)


def coordinates(m: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks as ``(i, j, v)``, without zeros."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bi, bj, r, c, d in zip(*(x.to_pylist() for x in batch.columns)):
                x = _matrix(r, c, d)
                i, j = np.nonzero(x)
                yield pa.RecordBatch.from_pydict({"i": bi * size + i, "j": bj * size + j, "v": x[i, j]})
    return m.mapInArrow(cells, "i long, j long, v double")


def matmul(a: DataFrame, b: DataFrame, transpose_a: bool = False, transpose_b: bool = False, size: int = BLOCK) -> DataFrame:
    """C = op(A) op(B) of coordinate tables, by blocks (indexes from 0; zeros are left out)."""
    return coordinates(blocks_product(blocks(a, size), blocks(b, size), transpose_a, transpose_b), size)


def diag_part(m: DataFrame) -> DataFrame:
    """(i, v) on the diagonal."""
    return m.filter(F.col("i") == F.col("j")).select("i", "v")


def trace_and_norm(m: DataFrame) -> DataFrame:
    """Trace and Frobenius norm in one pass."""
    return m.agg(F.sum(F.when(F.col("i") == F.col("j"), F.col("v")).otherwise(0.0)).alias("trace"),
                 F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))


def eye(spark, n: int, m: int | None = None) -> DataFrame:
    """Identity (n x m) as nonzero coordinates."""
    m = n if m is None else m
    return spark.range(min(n, m)).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("v"))


def diag(values: DataFrame, idx_col: str = "i", value_col: str = "v") -> DataFrame:
    """Square matrix with the given diagonal."""
    return values.select(F.col(idx_col).alias("i"), F.col(idx_col).alias("j"), F.col(value_col).cast("double").alias("v"))


def set_diag(m: DataFrame, values: DataFrame) -> DataFrame:
    """L04 matrix_set_diag: replace the diagonal."""
    off = m.filter(F.col("i") != F.col("j"))
    return off.unionByName(diag(values))


def band_part(m: DataFrame, lower: int, upper: int) -> DataFrame:
    """Keep entries with -lower <= j - i <= upper (negative = all)."""
    cond = F.lit(True)
    if lower >= 0:
        cond = cond & (F.col("i") - F.col("j") <= lower)
    if upper >= 0:
        cond = cond & (F.col("j") - F.col("i") <= upper)
    return m.filter(cond)


def _whole_rows(df: DataFrame, vec_col: str) -> tuple[DataFrame, int]:
    """The rows without NULL as ``x``, and their common length (0 without rows)."""
    rows = df.select(F.col(vec_col).cast("array<double>").alias("x")).filter(F.forall("x", lambda v: v.isNotNull()))
    lengths = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if lengths.least != lengths.most:
        raise ValueError(f"rows of {lengths.least} to {lengths.most} numbers in column {vec_col}")
    return rows, lengths.most or 0


def gram_matrix(df: DataFrame, vec_col: str) -> DataFrame:
    """A'A of the matrix whose rows are an array column: (i, j, v), 0-based.
    One pass; every task adds up its batches' d x d products and emits one
    block, so d^2 numbers per task are shuffled and no row is copied. Rows
    that are NULL or hold NULL are left out; rows of several lengths are an error."""
    rows, _ = _whole_rows(df, vec_col)

    def add_up(batches):
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0)
            m = np.asarray(x.flatten(), np.float64).reshape(b.num_rows, -1)
            total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            i, j = (k.reshape(-1) for k in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "v"])
    return rows.mapInArrow(add_up, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))


def triangular_factor(df: DataFrame, vec_col: str) -> np.ndarray:
    """R of the QR factorization of the matrix whose rows are an array column (d x d, on the driver).

    Every task folds its batches into one triangle (Householder); triangles are merged ``FAN_IN`` at
    a time until one is left, so no task holds more than a batch and ``FAN_IN`` triangles."""
    rows, d = _whole_rows(df, vec_col)
    if not d:
        return np.zeros((0, 0))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            if b.num_rows:
                x = b.column(b.num_columns - 1)
                x = np.frombuffer(b"".join(x.to_pylist()), "<f8") if pa.types.is_binary(x.type) else x.flatten().to_numpy(zero_copy_only=False)
                r = np.linalg.qr(np.concatenate([r, x.reshape(-1, d)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([np.ascontiguousarray(r, "<f8").tobytes()], pa.binary())})

    found = reliable_checkpoint(rows.mapInArrow(fold, "r binary"))
    while (n := found.count()) > 1:
        found = reliable_checkpoint(found.repartition(-(-n // FAN_IN)).mapInArrow(fold, "r binary"))
    last = [r.r for r in found.collect()]  # one triangle
    out = np.zeros((d, d))
    if last:
        r = np.frombuffer(last[0], "<f8").reshape(-1, d)
        out[:len(r)] = r
    return out


def _staircase(r: np.ndarray) -> np.ndarray:
    """R with the same R'R, positive pivots, and a zero row at the end for every column that depends on those before it."""
    r, at = r.copy(), 0
    small = len(r) * np.finfo(float).eps
    sizes = np.linalg.norm(r, axis=0)
    for j in range(len(r)):
        part = r[at:, j]
        if np.linalg.norm(part) <= small * sizes[j]:
            r[at:, j] = 0
            continue
        if len(part) > 1:
            r[at:, j:] = np.linalg.qr(r[at:, j:], mode="complete")[1] if np.any(part[1:]) else r[at:, j:]
            r[at + 1:, j] = 0
        if r[at, j] < 0:
            r[at] *= -1
        at += 1
    r[at:] = 0
    return r


def svd(df: DataFrame, vec_col: str, k: int | None = None):
    """(singular values, right vectors d x k), largest first, of a tall
    matrix: those of its triangular factor, so small ones keep their digits."""
    _, values, right = np.linalg.svd(triangular_factor(df, vec_col))
    return values[:k], right.T[:, :k]


def tall_skinny_qr(df: DataFrame, vec_col: str) -> np.ndarray:
    """R factor of a tall-skinny QR: upper triangular, positive pivots,
    zero rows at the end where columns depend on others."""
    return _staircase(triangular_factor(df, vec_col))


def orthonormal_rows(df: DataFrame, vec_col: str, r: np.ndarray, out_col: str = "q") -> DataFrame:
    """The rows of Q, ``x R^-1`` (pseudo-inverse where R has zero rows), row by row; NULL for rows R was not made of."""
    solve = np.linalg.pinv(r)
    terms = [F.array(*[F.lit(float(v)) for v in solve[:, j]]) for j in range(solve.shape[1])]
    x = F.col(vec_col).cast("array<double>")
    dot = lambda t: F.aggregate(F.zip_with(x, t, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return df.withColumn(out_col, F.when(F.forall(x, lambda v: v.isNotNull()), F.array(*[dot(t) for t in terms])))


def principal_components(df: DataFrame, vec_col: str, k: int | None = None):
    """L08 / E15 (re-aimed): (variances, components d x k) of the covariance
    matrix, largest first, by ``pyspark.ml.feature.PCA``."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    x = df.select(F.col(vec_col).cast("array<double>").alias("x"))
    d = x.select(F.size("x")).first()[0]
    spread = x.agg(*[F.var_samp(F.col("x")[j]).alias(f"v{j}") for j in range(d)]).first()
    model = PCA(k=k or d, inputCol="f", outputCol="p").fit(x.select(array_to_vector("x").alias("f")))
    return model.explainedVariance.toArray() * sum(spread), model.pc.toArray()


def least_squares(df: DataFrame, feature_cols, label_col: str) -> np.ndarray:
    """From the triangular factor of (features, label), which keeps the
    condition number of the features; rows with a NULL are left out. The least
    norm solution where columns depend on each other."""
    cols = [*feature_cols, label_col]
    r = triangular_factor(df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x")), "x")
    if not len(r):
        return np.zeros(len(cols) - 1)
    return np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=None)[0]
