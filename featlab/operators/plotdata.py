"""Summary tables behind common plots.

Drawing is not done here; each function returns the small aggregated table
a chart needs. Everything is an aggregation over the full data (bins,
grid points, quantiles), never a sample of rows - except ``sample_by``,
whose purpose is sampling.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featlab.functions.hashing import md5_mod
from featlab.operators.stats import attach_row, exact_quantiles


def _range(df: DataFrame, col: str):
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n"),
               F.avg(col).alias("mean"), F.stddev_pop(col).alias("std")).first()
    return r["lo"], r["hi"], r["n"], r["mean"], r["std"]


def histogram(df: DataFrame, col: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed): count and
    density per bin."""
    lo, hi, n, _, _ = _range(df, col)
    if not n:   # no values: no bins
        lo = hi = 0.0
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    out = df.filter(F.col(col).isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return out.select(*by, "bin", (F.lit(lo) + F.col("bin") * width).alias("left"),
                      "count", (F.col("count") / (F.lit(n) * width)).alias("density"))


def kde(df: DataFrame, col: str, points: int = 50, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max]. Values
    are counted first; each distinct one adds its kernel value, times its
    count, to every grid point (map-side partial aggregation)."""
    lo, hi, n, _, std = _range(df, col)
    if not n:   # no values: no curve
        lo = hi = std = 0.0
    h = bandwidth or 1.06 * std * max(n, 1) ** (-0.2) or 1.0   # a constant column gets unit bandwidth
    step = (hi - lo) / (points - 1)
    g = F.lit(lo) + F.col("gi") * step
    rows = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull()).groupBy("x").agg(F.count(F.lit(1)).alias("times")) \
             .select("x", "times", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("gi"))
    k = F.exp(-F.pow(F.col("x") - g, 2) / (2 * h * h)) / (h * math.sqrt(2 * math.pi))
    return rows.groupBy("gi").agg((F.sum(k * F.col("times")) / n).alias("density")).select(
        "gi", (F.lit(lo) + F.col("gi") * step).alias("x"), "density")


def box_summary(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme points inside the
    fences) and outlier count per group."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by)
    wide = q.groupBy(*by).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    wide = wide.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = F.col(col)
    j = df.select(*by, x.cast("double").alias(col)).join(wide, list(by)) if by else attach_row(df.select(x.cast("double").alias(col)), wide)
    lo_f, hi_f = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    agg = j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(x >= lo_f, x)).alias("whisker_lo"), F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("outliers"))
    return agg


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every column pair, one aggregation, long form."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    st = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs]
    return row.select(F.explode(F.array(*st)).alias("s")).select("s.*")


def pie_shares(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share (%) of the total per key."""
    per = df.groupBy(key).agg(F.sum(value).alias("total"))
    return attach_row(per, per.agg(F.sum("total").alias("_fl_all"))) \
        .select(key, "total", (100 * F.col("total") / F.col("_fl_all")).alias("share_pct"))


def stacked_bars(df: DataFrame, x: str, series: str, value: str) -> DataFrame:
    """Per (x, series) sum and its running stack across series (the
    window is per x over its few series)."""
    per = df.groupBy(x, series).agg(F.sum(value).alias("total"))
    w = Window.partitionBy(x).orderBy(series).rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("stack_top", F.sum("total").over(w))


def line_series(df: DataFrame, ts: str, series: str, value: str, unit: str = "day") -> DataFrame:
    """Per (time bucket, series) mean and count, ordered by time."""
    t = F.date_trunc(unit, F.col(ts).cast("timestamp"))
    return df.groupBy(t.alias("bucket"), series).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))


def sample_by(df: DataFrame, id_col: str, fraction: float, buckets: int = 1_000_000) -> DataFrame:
    """Deterministic sample for scatter / pair plots: rows whose md5
    bucket of the id falls below the fraction (same rows every run)."""
    return df.filter(md5_mod(F.col(id_col).cast("string"), buckets) < int(fraction * buckets))


def joint_bins(df: DataFrame, xcol: str, ycol: str, bins: int = 10) -> DataFrame:
    """Rectangular 2-D bins with counts (marginals: :func:`joint_marginals`);
    rows without either value are left out, an empty table has no bins."""
    df = df.filter(F.col(xcol).isNotNull() & F.col(ycol).isNotNull())
    lx, hx, n, _, _ = _range(df, xcol)
    ly, hy, _, _, _ = _range(df, ycol)
    if not n:
        lx = hx = ly = hy = 0.0
    wx = (hx - lx) / bins if hx > lx else 1.0
    wy = (hy - ly) / bins if hy > ly else 1.0
    bx = F.least(F.floor((F.col(xcol) - lx) / wx), F.lit(bins - 1)).cast("int")
    by_ = F.least(F.floor((F.col(ycol) - ly) / wy), F.lit(bins - 1)).cast("int")
    return df.groupBy(bx.alias("bx"), by_.alias("by")).agg(F.count(F.lit(1)).alias("count"))


def joint_marginals(bins: DataFrame) -> DataFrame:
    """The counts of :func:`joint_bins` per axis (``axis`` "x" or "y", ``bin``, ``count``)."""
    both = F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.col("bx").alias("bin")), F.struct(F.lit("y").alias("axis"), F.col("by").alias("bin"))))
    return bins.select(both.alias("_fl_m"), "count").groupBy("_fl_m.axis", "_fl_m.bin").agg(F.sum("count").alias("count"))


def fitted_lines(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per facet (order 1)."""
    return df.groupBy(*by).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                               F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                               F.count(F.lit(1)).alias("n"))


def pair_rows(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form for pair plots / scatter matrices: one row per ordered
    pair of distinct columns (fx, fy, x, y), carrying ``keep`` columns
    (label, ids). Usually applied after :func:`sample_by`."""
    pairs = [(a, b) for a in cols for b in cols if a != b]
    st = [F.struct(F.lit(a).alias("fx"), F.lit(b).alias("fy"), F.col(a).cast("double").alias("x"),
                   F.col(b).cast("double").alias("y")) for a, b in pairs]
    return df.select(*keep, F.explode(F.array(*st)).alias("_fl_p")).select(*keep, "_fl_p.*")
