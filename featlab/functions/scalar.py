"""Row-local numeric functions (P01-P25): ``Column -> Column``.

All are built-in Spark expressions, so they stay inside whole-stage
codegen and also run on streaming frames.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- P01 / P02 -------------------------------------------------------------
def is_float(x) -> Column:
    """String parses as a float (accepts ``1e3``, ``nan``, ``inf``)."""
    return _c(x).try_cast("double").isNotNull()


def is_int(x) -> Column:
    """String is an optionally signed run of digits (surrounding blanks ok)."""
    return _c(x).rlike(r"^\s*[+-]?\d+\s*$")


# ---- P03-P08: binning and transforms ---------------------------------------
def fixed_box(x, bounds: Sequence[float]) -> Column:
    """Index of the first bound with ``x < bound``; ``len(bounds)`` when none
    (NaN sorts above every number in Spark, so it lands in the last bin)."""
    bounds = list(bounds)
    if any(a > b for a, b in zip(bounds, bounds[1:])):
        raise ValueError("bounds must be sorted ascending")
    c = _c(x)
    expr = F.when(c.isNull(), None)
    for i, b in enumerate(bounds):
        expr = expr.when(c < F.lit(b), F.lit(i))
    return expr.otherwise(F.lit(len(bounds)))


def average_box(x, width: float) -> Column:
    return F.floor(_c(x) / F.lit(width))


def log_box(x) -> Column:
    """Order of magnitude ``floor(log10 x)``; NULL for x <= 0."""
    return F.floor(F.log10(_c(x)))


def log_trans(x, base: float) -> Column:
    return F.log(float(base), _c(x))


def box_cox(x, lam: float) -> Column:
    """Fixed-lambda Box-Cox; NULL for x <= 0."""
    c = _c(x)
    pos = F.when(c > 0, c)
    if lam == 0:
        return F.log(pos)
    return (F.pow(pos, F.lit(lam)) - 1) / F.lit(lam)


def atan_2pi(x) -> Column:
    """atan(x) * 2 / pi, maps the real line onto (-1, 1)."""
    return F.atan(_c(x)) * F.lit(2.0 / math.pi)


# ---- P09 / C03 ---------------------------------------------------------------
def one_hot(index, depth: int, on=1, off=0) -> Column:
    """Array of ``depth`` values, ``on`` at ``index`` and ``off`` elsewhere."""
    idx = _c(index)
    return F.transform(F.sequence(F.lit(0), F.lit(depth - 1)),
                       lambda i: F.when(i == idx, F.lit(on)).otherwise(F.lit(off)))


# ---- P14 -------------------------------------------------------------------
def f_score(p, r) -> Column:
    """2pr / (p + r); NULL when p + r = 0."""
    p, r = _c(p), _c(r)
    return F.when(p + r != 0, 2 * p * r / (p + r))


# ---- P16-P25: element-wise arithmetic --------------------------------------
def add(a, b): return _c(a) + _c(b)
def subtract(a, b): return _c(a) - _c(b)
def multiply(a, b): return _c(a) * _c(b)
def divide(a, b): return F.try_divide(_c(a), _c(b))          # NULL on /0


def floordiv(a, b) -> Column:
    return F.floor(F.try_divide(_c(a), _c(b)))


def truncatediv(a, b) -> Column:
    """Integer division rounding toward zero (``div``)."""
    a, b = _c(a), _c(b)
    return F.when(b != 0, (a.cast("double") / b).cast("long"))


def floormod(a, b) -> Column:
    """Python-style modulo: result has the sign of the divisor."""
    a, b = _c(a), _c(b)
    return F.when(b != 0, a - b * F.floor(a / b))


def truncatemod(a, b) -> Column:
    """C-style remainder: result has the sign of the dividend."""
    a, b = _c(a), _c(b)
    return F.when(b != 0, a % b)


def square(x): return _c(x) * _c(x)
def reciprocal(x): return F.try_divide(F.lit(1.0), _c(x))
def rint(x): return F.bround(_c(x), 0)                        # half to even
def maximum(a, b): return F.greatest(_c(a), _c(b))
def minimum(a, b): return F.least(_c(a), _c(b))
def squared_difference(a, b): return F.pow(_c(a) - _c(b), 2)
def where(cond, x, y): return F.when(_c(cond), _c(x)).otherwise(_c(y))


def safe_acos(x) -> Column:
    c = _c(x)
    return F.when(F.abs(c) <= 1, F.acos(c))


def safe_asin(x) -> Column:
    c = _c(x)
    return F.when(F.abs(c) <= 1, F.asin(c))


def add_n(*cols) -> Column:
    """Sum of many same-shape inputs (scalars)."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def add_n_arrays(*cols) -> Column:
    """Element-wise sum of many same-length arrays."""
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [_c(c) for c in cols])


def cross3(a, b) -> Column:
    """Cross product of two 3-vectors (arrays, 1-based element_at)."""
    a, b = _c(a), _c(b)
    e = F.element_at
    return F.array(e(a, 2) * e(b, 3) - e(a, 3) * e(b, 2),
                   e(a, 3) * e(b, 1) - e(a, 1) * e(b, 3),
                   e(a, 1) * e(b, 2) - e(a, 2) * e(b, 1))


# ---- P26: random and constant columns --------------------------------------
def random_normal(seed: int, mean: float = 0.0, stddev: float = 1.0) -> Column:
    return F.randn(seed) * stddev + mean


def random_uniform(seed: int, low: float = 0.0, high: float = 1.0) -> Column:
    return F.rand(seed) * (high - low) + low


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def ones(n: int) -> Column:
    return F.array_repeat(F.lit(1.0), n)


def fill(n: int, value) -> Column:
    return F.array_repeat(F.lit(value), n)


# ---- P26 (cont.): gamma and truncated normal columns ----------------------------------
def with_random_columns(df, seed: int, gamma: dict | None = None, truncated_normal: dict | None = None):
    """Adds ``gamma`` (``{"name": (shape, scale)}``) and ``truncated_normal``
    (``{"name": (mean, std)}``, redrawn until inside mean +- 2 std, as the
    tensor library's truncated normal does) columns. numpy generators run
    per partition, seeded by (seed, partition index); like ``randn`` the
    values are reproducible for a fixed partitioning of the input."""
    import numpy as np
    from pyspark import TaskContext
    from pyspark.sql.types import DoubleType, StructField, StructType

    gamma, truncated_normal = gamma or {}, truncated_normal or {}
    schema = StructType([*df.schema.fields, *[StructField(n, DoubleType()) for n in (*gamma, *truncated_normal)]])

    def run(it):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for pdf in it:
            n = len(pdf)
            for name, (shape, scale) in gamma.items():
                pdf[name] = rng.gamma(shape, scale, n)
            for name, (mean, std) in truncated_normal.items():
                z = rng.standard_normal(n)
                bad = np.abs(z) > 2
                while bad.any():                      # redraw only the rejected values
                    z[bad] = rng.standard_normal(int(bad.sum()))
                    bad = np.abs(z) > 2
                pdf[name] = mean + std * z
            yield pdf
    return df.mapInPandas(run, schema)
