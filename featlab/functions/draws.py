"""Random columns as functions of (seed, id, number of the draw).

Every value is a column expression over an md5 digest, so it does not depend on
how rows are partitioned, a recomputed task gives the same rows, and any engine
with md5 gives the same numbers. A value that is drawn anew until it fits takes
its draws in order and stops at the first that does; ``ROUNDS`` draws fail with
a chance below 1e-20, after which the distribution's centre stands in.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Draws of a value that may be rejected.
ROUNDS = 16


def uniform(seed: int, id_col: Column | str, draw: Column | int = 0, low: float = 0.0, high: float = 1.0) -> Column:
    """Even on (low, high): 52 bits of the md5 of ``"seed:id:draw"``."""
    key = F.concat_ws(":", F.lit(str(seed)), (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"),
                      (draw if isinstance(draw, Column) else F.lit(draw)).cast("string"))
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52)) * F.lit(high - low) + F.lit(low)


def normal(seed: int, id_col: Column | str, draw: Column | int = 0, mean: float = 0.0, std: float = 1.0) -> Column:
    """Box-Muller over draws ``2 draw`` and ``2 draw + 1``."""
    first = (draw if isinstance(draw, Column) else F.lit(draw)) * 2
    z = F.sqrt(-2 * F.log(uniform(seed, id_col, first))) * F.cos(F.lit(2 * math.pi) * uniform(seed, id_col, first + 1))
    return z * std + mean


def _first_that_fits(candidate) -> Column:
    """The first non-NULL ``candidate(round)``; later rounds are not evaluated."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.lit(None).cast("double"), lambda got, r: F.when(got.isNotNull(), got).otherwise(candidate(r)))


def truncated_normal(seed: int, id_col: Column | str, mean: float = 0.0, std: float = 1.0) -> Column:
    """Normal values, drawn anew until within two standard deviations."""
    def candidate(r: Column) -> Column:
        z = normal(seed, id_col, r)
        return F.when(F.abs(z) <= 2, z)
    return F.coalesce(_first_that_fits(candidate), F.lit(0.0)) * std + mean


def gamma(seed: int, id_col: Column | str, shape: float, scale: float = 1.0) -> Column:
    """Marsaglia and Tsang's method; round r uses draws 3r to 3r + 2. Shapes below one are
    those of shape + 1 times ``u^(1 / shape)``."""
    a = shape if shape >= 1 else shape + 1
    d = a - 1 / 3
    c = 1 / math.sqrt(9 * d)

    def candidate(r: Column) -> Column:
        x = F.sqrt(-2 * F.log(uniform(seed, id_col, r * 3))) * F.cos(F.lit(2 * math.pi) * uniform(seed, id_col, r * 3 + 1))
        root = 1 + x * c
        v = root * root * root
        fits = (root > 0) & (F.log(uniform(seed, id_col, r * 3 + 2)) < x * x / 2 + d - v * d + F.log(F.greatest(v, F.lit(1e-300))) * d)
        return F.when(fits, v * d)
    out = F.coalesce(_first_that_fits(candidate), F.lit(d)) * scale
    return out if shape >= 1 else out * F.pow(uniform(seed, id_col, -1), F.lit(1 / shape))
