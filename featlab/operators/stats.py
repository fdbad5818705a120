"""Aggregations: reductions, segments, quantiles, selection statistics
(A01-A05, A11-A16, A29, F01, F02).

Every multi-column statistic is one ``agg`` (partial aggregation map-side,
one tiny final stage); per-column results are unpivoted into long form
``(feature, ...)`` so the output shape does not depend on the column count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row statistics frame on every row.
    An equi-join on a constant key with the one-row side broadcast (its size
    is fixed at one row)."""
    k = "_fl_one"
    return (df.withColumn(k, F.lit(1))
            .join(F.broadcast(one_row.withColumn(k, F.lit(1))), k).drop(k))


def _long(row_df: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One-row ``{col}__{field}`` frame -> rows ``(feature, field...)``."""
    structs = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{f}").alias(f) for f in fields])
               for c in cols]
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


# ---- A01-A03: reductions ------------------------------------------------------------
def reduce_all(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum / mean / max / min / prod / all(x != 0) / any(x != 0) / nonzero count."""
    x = F.col(col).cast("double")
    aggs = [F.sum(x).alias("sum"), F.avg(x).alias("mean"), F.max(x).alias("max"),
            F.min(x).alias("min"), F.product(x).alias("prod"),
            F.bool_and(x != 0).alias("all"), F.bool_or(x != 0).alias("any"),
            F.count_if(x != 0).alias("count_nonzero")]
    return df.groupBy(*by).agg(*aggs)


def logsumexp(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """M + ln(sum(exp(x - m))) with m = max(x), per group. The max is a
    window per group here only when grouped; ungrouped it is a literal."""
    x = F.col(col).cast("double")
    if by:
        m = df.groupBy(*by).agg(F.max(x).alias("_fl_m"))
        j = df.join(m, list(by))
        return j.groupBy(*by).agg((F.first("_fl_m") + F.log(F.sum(F.exp(x - F.col("_fl_m"))))).alias("logsumexp"))
    mx = df.agg(F.max(x)).first()[0]
    return df.agg((F.lit(mx) + F.log(F.sum(F.exp(x - F.lit(mx))))).alias("logsumexp"))


def reduce_row(values) -> dict:
    """A01 along a row: the same reductions of an array column as a dict of
    columns, by folds inside the row. NULL items count as missing; an empty
    array has sum 0, prod 1, all true, any false and NULL mean, max, min."""
    x = F.filter(F.transform(F.col(values) if isinstance(values, str) else values, lambda v: v.cast("double")), lambda v: v.isNotNull())
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    return {"sum": total, "mean": F.when(F.size(x) > 0, total / F.size(x)), "max": F.array_max(x), "min": F.array_min(x),
            "prod": F.aggregate(x, F.lit(1.0), lambda a, v: a * v), "all": F.forall(x, lambda v: v != 0), "any": F.exists(x, lambda v: v != 0),
            "count_nonzero": F.size(F.filter(x, lambda v: v != 0)).cast("bigint")}


def segment_reduce(df: DataFrame, seg: str, col: str, n_segments: int | None = None) -> DataFrame:
    """segment_sum / mean / max / min / prod. Empty segments are absent,
    or with ``n_segments`` every id below it has a row: sum, mean, max and min
    0, prod 1 where nothing falls in; ids outside 0..n-1 and NULL are dropped."""
    x = F.col(col)
    out = df.groupBy(seg).agg(F.sum(x).alias("sum"), F.avg(x).alias("mean"), F.max(x).alias("max"),
                              F.min(x).alias("min"), F.product(x).alias("prod"))
    if n_segments is None:
        return out
    every = df.sparkSession.range(n_segments).select(F.col("id").cast(df.schema[seg].dataType).alias(seg))
    empty = {"sum": 0, "mean": 0, "max": 0, "min": 0, "prod": 1}
    return every.join(out, seg, "left").select(seg, *[F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)).alias(c) for c, v in empty.items()])


def sparse_segment(df: DataFrame, seg: str, col: str) -> DataFrame:
    """sparse_segment sum / mean / sqrt_n over the selected rows."""
    x = F.col(col).cast("double")
    return df.groupBy(seg).agg(F.sum(x).alias("sum"), F.avg(x).alias("mean"),
                               (F.sum(x) / F.sqrt(F.count(x))).alias("sqrt_n"))


# ---- A11 / A12: quantiles -------------------------------------------------------------
def quantiles(df: DataFrame, col: str, probs: Sequence[float], exact: bool = True) -> DataFrame:
    """Linear-interpolated quantiles (exact, rank based), or the
    mergeable sketch ``percentile_approx`` when ``exact`` is False."""
    if exact:
        return exact_quantiles(df, col, probs)
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    q = F.percentile_approx(F.col(col), probs_arr, 10000)
    row = df.agg(q.alias("q"))
    return row.select(F.posexplode("q").alias("i", "value")).select(
        F.element_at(probs_arr, F.col("i") + 1).alias("prob"), "value")


def quantile_bins(df: DataFrame, col: str, q: int, out_col: str = "bin", exact: bool = True,
                  duplicates: str = "raise") -> DataFrame:
    """Q equal-frequency bins, right-closed, lowest value included:
    bin = number of inner edges strictly below x. Edges are q-1 literals
    computed by one aggregation."""
    probs = [0.0, *[i / q for i in range(1, q)], 1.0]
    edges = [r["value"] for r in quantiles(df, col, probs, exact).orderBy("prob").collect()]   # q + 1 numbers
    if len(set(edges)) < len(edges):
        if duplicates == "raise":
            raise ValueError(f"bin edges must be unique: {edges}")
        edges = sorted(set(edges))
    inner = edges[1:-1]
    x = F.col(col)
    b = sum((F.when(x > F.lit(e), 1).otherwise(0) for e in inner), F.lit(0))
    return df.withColumn(out_col, F.when(x.isNull(), None).otherwise(b))


# ---- A13-A15, F01, F02: feature screening ---------------------------------------------
def variance_report(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Sample variance per column and the low-variance flag."""
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"{c}__var") for c in cols])
    out = _long(row, cols, ["var"])
    return out.withColumn("low_variance", F.col("var") < F.lit(threshold))


def mode_report(df: DataFrame, cols: Sequence[str], share: float = 0.95) -> DataFrame:
    """Most frequent value per discrete column (ties: smallest
    value as text), its share of rows, and the dominant flag. One unpivot
    + one aggregation for all columns."""
    st = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    long = df.select(F.explode(F.array(*st)).alias("s")).select("s.*")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.min_by(F.col("value"), F.struct(-F.col("n"), F.col("value"))).alias("mode"),
        F.max("n").alias("mode_count"), F.sum("n").alias("rows"))
    return best.select("feature", "mode", "mode_count", (F.col("mode_count") / F.col("rows")).alias("share"),
                       (F.col("mode_count") / F.col("rows") >= share).alias("dominant"))


def pearson_report(df: DataFrame, cols: Sequence[str], label: str, threshold: float) -> DataFrame:
    """Correlation of each column with the label, one pass;
    flag |r| <= threshold for removal."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"{c}__r") for c in cols])
    return _long(row, cols, ["r"]).withColumn("remove", F.abs("r") <= F.lit(threshold))


def category_target_stats(df: DataFrame, cat: str, target: str) -> DataFrame:
    """Mean and count of the target per category."""
    return df.groupBy(cat).agg(F.avg(target).alias("mean"), F.count(F.lit(1)).alias("count"))


def bin_counting(df: DataFrame, cat: str, click: str, log: bool = False) -> DataFrame:
    """Per category CTR and odds ratio against all other categories.
    Totals come from the (small) per-category aggregate, not the rows."""
    per = df.groupBy(cat).agg(F.sum(F.col(click).cast("double")).alias("clicks"),
                              F.count(F.lit(1)).alias("n"))
    tot = per.agg(F.sum("clicks").alias("_tc"), F.sum("n").alias("_tn"))
    per = attach_row(per, tot).withColumn("ctr", F.col("clicks") / F.col("n"))
    rest_c, rest_n = F.col("_tc") - F.col("clicks"), F.col("_tn") - F.col("n")
    odds = (F.col("clicks") / (F.col("n") - F.col("clicks"))) / (rest_c / (rest_n - rest_c))
    per = per.withColumn("odds_ratio", F.log(odds) if log else odds)
    return per.drop("_tc", "_tn")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles: (by..., prob, value).

    Rows are first counted per (group, value) with map-side partial sums, so
    a value that most rows share is one row; the distinct values are ranged,
    their counts accumulated (inside a range, then over the ranges' totals),
    and each probability picks the values that cover the two order
    statistics around h = (n - 1) p + 1."""
    from featlab.operators.ordering import _LOC, _PID, ranged_local_numbers
    from featlab.session import reliable_checkpoint
    by = list(by)
    counts = df.select(*by, F.col(col).cast("double").alias("_fl_x")).filter(F.col("_fl_x").isNotNull()) \
        .groupBy(*by, "_fl_x").agg(F.count(F.lit(1)).alias("_fl_c"))
    ranged = reliable_checkpoint(ranged_local_numbers(counts, [*by, F.col("_fl_x")]))
    parts = ranged.groupBy(_PID, *by).agg(F.sum("_fl_c").alias("_fl_s"))
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)   # one row per range and group
    parts = parts.select(_PID, *by, F.coalesce(F.sum("_fl_s").over(before), F.lit(0)).alias("_fl_off"),
                         F.sum("_fl_s").over(Window.partitionBy(*by)).alias("_fl_n"))
    inside = Window.partitionBy(_PID, *by).orderBy(_LOC).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_fl_off") + F.col("_fl_run")
    rows = ranged.withColumn("_fl_run", F.sum("_fl_c").over(inside)).join(parts, [_PID, *by]) \
        .withColumn("_fl_first", last - F.col("_fl_c") + 1).withColumn("_fl_last", last)

    def pick(p):
        h = (F.col("_fl_n") - 1) * p + 1
        lo = F.floor(h)
        covers = lambda r: (F.col("_fl_first") <= r) & (r <= F.col("_fl_last"))
        return F.struct(p.alias("prob"), (h - lo).alias("part"), F.when(covers(lo), F.col("_fl_x")).alias("low"),
                        F.when(covers(F.least(lo + 1, F.col("_fl_n"))), F.col("_fl_x")).alias("high"))
    hits = F.filter(F.transform(F.array(*[F.lit(float(p)) for p in probs]), pick), lambda s: s["low"].isNotNull() | s["high"].isNotNull())
    picked = rows.select(*by, F.explode(hits).alias("_fl_hit")).select(*by, "_fl_hit.*")
    return picked.groupBy(*by, "prob").agg((F.max("low") + F.max("part") * (F.max("high") - F.max("low"))).alias("value"))


def measurement_quality(df: DataFrame, group: str, measured: str, true: str | None = None) -> DataFrame:
    """Repeat-measurement quality per item: precision (sample std of
    the repeats), bias (mean of measured - true) and the number of
    outliers outside the 1.5 IQR fences (exact quartiles per item)."""
    x = F.col(measured).cast("double")
    base = df.select(group, x.alias("_fl_m"), *([F.col(true).cast("double").alias("_fl_t")] if true else []))
    q = exact_quantiles(base, "_fl_m", [0.25, 0.75], [group])
    fences = q.groupBy(group).agg(F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("_q1"),
                                  F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("_q3"))
    j = base.join(fences, group)
    iqr = F.col("_q3") - F.col("_q1")
    out = (F.col("_fl_m") < F.col("_q1") - 1.5 * iqr) | (F.col("_fl_m") > F.col("_q3") + 1.5 * iqr)
    aggs = [F.count(F.lit(1)).alias("n"), F.stddev_samp("_fl_m").alias("precision"), F.count_if(out).alias("outliers")]
    if true:
        aggs.insert(2, F.avg(F.col("_fl_m") - F.col("_fl_t")).alias("bias"))
    return j.groupBy(group).agg(*aggs)
