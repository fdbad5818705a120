"""Stable hashing (E04-E07): md5 bins and signed feature hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def md5_mod(x, m: int) -> Column:
    """``int(md5(x) as 128-bit) % m`` without 128-bit arithmetic: fold the
    four 32-bit chunks of the hex digest, ``acc = (acc * 2^32 + chunk) % m``,
    which stays inside bigint while ``m < 2^31``."""
    if not 0 < m < 2 ** 31:
        raise ValueError("modulus must be in (0, 2^31)")
    h = F.md5(_c(x).cast("string"))
    if m & (m - 1) == 0:   # m divides 2^32: all chunks but the last fall away
        return F.pmod(F.conv(F.substring(h, 25, 8), 16, 10).cast("bigint"), F.lit(m).cast("bigint"))
    acc = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = F.pmod(acc * F.lit(2 ** 32) + chunk, F.lit(m))
    return acc


def md5_bin(x, nr_bins: int = 1_000_000) -> Column:
    """md5 of the text mod (nr_bins - 1), plus 1 (bin 0 stays free)."""
    return md5_mod(x, nr_bins - 1) + 1


def hash_bucket(x, n_features: int, seed: int = 0) -> Column:
    """Bucket of a token: md5 of ``seed:token`` mod ``n_features``, the
    same in every process and engine (not salted like Python's ``hash``)."""
    return md5_mod(F.concat(F.lit(f"{seed}:"), _c(x).cast("string")), n_features).cast("int")


def hash_sign(x, seed: int = 0) -> Column:
    """+1/-1 from an independent hash (a different seed), so the sign
    is not tied to the bucket."""
    return F.when(md5_mod(F.concat(F.lit(f"{seed + 7919}:"), _c(x).cast("string")), 2) == 0, 1).otherwise(-1)
