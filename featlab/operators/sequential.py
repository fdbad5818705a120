"""Order-dependent operators (W01-W07, W11) that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to
one task; with one key holding a third of the data that task is the job.
Here each key's rows are numbered by :func:`global_rank` (range partitioned
on the total order, so a hot key spans many tasks) and cut into chunks of
at most ``chunk_rows`` rows:

* bounded frames (moving average, sliding min/max, lag/lead) copy the
  ``halo`` neighbouring rows into the adjacent chunk, evaluate the window
  per (key, chunk) and drop the copies;
* running totals (cumulative sum, exponential average) compute chunk-local
  values and add a carry from the earlier chunks, taken from a per-chunk
  summary table (one row per chunk).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featlab.operators.ordering import global_rank

CHUNK_ROWS = 1_000_000


def _ranked(df: DataFrame, keys: Sequence[str], order_by: Sequence, chunk_rows: int) -> DataFrame:
    r = global_rank(df, order_by, "_fl_rank", partition_by=keys)
    return r.withColumn("_fl_chunk", F.floor((F.col("_fl_rank") - 1) / chunk_rows))


def with_halo(df: DataFrame, keys: Sequence[str], order_by: Sequence, before: int, after: int = 0,
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows with ``_fl_rank`` (1-based within key) and ``_fl_chunk``; the last
    ``before`` rows of each chunk are copied into the next chunk and the
    first ``after`` rows into the previous one, flagged ``_fl_halo``."""
    chunk_rows = max(chunk_rows, before, after)   # a window reaches into the next chunk only
    r = _ranked(df, keys, order_by, chunk_rows)
    pos = (F.col("_fl_rank") - 1) % chunk_rows
    own = r.withColumn("_fl_halo", F.lit(False))
    parts = [own]
    if before:
        parts.append(r.filter(pos >= chunk_rows - before)
                     .withColumn("_fl_chunk", F.col("_fl_chunk") + 1).withColumn("_fl_halo", F.lit(True)))
    if after:
        parts.append(r.filter((pos < after) & (F.col("_fl_chunk") > 0))
                     .withColumn("_fl_chunk", F.col("_fl_chunk") - 1).withColumn("_fl_halo", F.lit(True)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sliding(df: DataFrame, keys: Sequence[str], order_by: Sequence, before: int, after: int,
            aggs: dict[str, Column], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Bounded-frame window aggregates ``rowsBetween(-before, after)`` per
    key, computed per (key, chunk) with halos. ``aggs`` maps output names to
    aggregate expressions (``F.avg("v")``...); adds ``_fl_rank``."""
    h = with_halo(df, keys, order_by, before, after, chunk_rows)
    w = Window.partitionBy(*keys, "_fl_chunk").orderBy("_fl_rank").rowsBetween(-before, after)
    out = h.withColumns({name: agg.over(w) for name, agg in aggs.items()})
    return out.filter(~F.col("_fl_halo")).drop("_fl_halo", "_fl_chunk")


def moving_average(df, keys, order_by, value: str, width: int, out_col: str = "moving_avg",
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean of the last ``width`` values; only full windows are kept."""
    out = sliding(df, keys, order_by, width - 1, 0,
                  {out_col: F.avg(value), "_fl_n": F.count(value)}, chunk_rows)
    return out.filter(F.col("_fl_n") == width).drop("_fl_n")


def sliding_range(df, keys, order_by, value: str, width: int = 20, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Sliding min / max over the last ``width`` rows (shorter at start)."""
    return sliding(df, keys, order_by, width - 1, 0,
                   {"min_" + value: F.min(value), "max_" + value: F.max(value)}, chunk_rows)


def context_window(df, keys, order_by, token: str, h: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The h tokens before and after each token (NULL past the ends),
    as columns ``ctx_m{i}`` / ``ctx_p{i}``; per document, never wrapping."""
    hh = with_halo(df, keys, order_by, h, h, chunk_rows)
    w = Window.partitionBy(*keys, "_fl_chunk").orderBy("_fl_rank")
    cols = {}
    for i in range(1, h + 1):
        cols[f"ctx_m{i}"] = F.lag(token, i).over(w)
        cols[f"ctx_p{i}"] = F.lead(token, i).over(w)
    return hh.withColumns(cols).filter(~F.col("_fl_halo")).drop("_fl_halo", "_fl_chunk")


def cumulative_sum(df: DataFrame, keys: Sequence[str], order_by: Sequence, value: str,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Inclusive, exclusive, reverse and reverse-exclusive running sums
    per key (``cumsum``, ``cumsum_excl``, ``cumsum_rev``, ``cumsum_rev_excl``)."""
    r = _ranked(df, keys, order_by, chunk_rows)
    v = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    wl = Window.partitionBy(*keys, "_fl_chunk").orderBy("_fl_rank").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("_fl_local", F.sum(v).over(wl))
    # per-chunk totals: one row per chunk, prefix over chunks of the same key
    summ = r.groupBy(*keys, "_fl_chunk").agg(F.sum(v).alias("_fl_csum"))
    wk = Window.partitionBy(*keys).orderBy("_fl_chunk")
    summ = (summ.withColumn("_fl_carry", F.coalesce(F.sum("_fl_csum").over(
                wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("_fl_total", F.sum("_fl_csum").over(Window.partitionBy(*keys)))
            .drop("_fl_csum"))
    j = r.join(summ, [*keys, "_fl_chunk"])
    inc = F.col("_fl_carry") + F.col("_fl_local")
    return (j.withColumn("cumsum", inc).withColumn("cumsum_excl", inc - v)
            .withColumn("cumsum_rev", F.col("_fl_total") - inc + v)
            .withColumn("cumsum_rev_excl", F.col("_fl_total") - inc)
            .drop("_fl_local", "_fl_carry", "_fl_total", "_fl_chunk"))


def ema(df: DataFrame, keys: Sequence[str], order_by: Sequence, value: str, beta: float = 0.999,
        debias: bool = False, chunk_rows: int = 100_000) -> DataFrame:
    """e_t = beta * e_{t-1} + (1 - beta) * x_t, e_0 = 0 (optionally
    divided by 1 - beta^t). Inside a chunk the closed form
    (1-beta) beta^p sum_i beta^-i x_i stays finite because chunks are cut to
    600 / |ln beta| rows at most; earlier chunks enter as carry * beta^(p+1).
    beta = 0 gives the values themselves, beta = 1 zeros (NULL with debias)."""
    if not 0 <= beta <= 1:
        raise ValueError("beta must be between 0 and 1")
    if beta in (0, 1):
        x = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
        flat = x if beta == 0 else F.lit(None if debias else 0.0).cast("double")
        return global_rank(df, order_by, "_fl_rank", partition_by=keys).withColumn("ema", flat)
    chunk_rows = max(1, min(chunk_rows, int(600 / -math.log(beta))))
    r = _ranked(df, keys, order_by, chunk_rows)
    p = ((F.col("_fl_rank") - 1) % chunk_rows).cast("double")
    x = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    wl = Window.partitionBy(*keys, "_fl_chunk").orderBy("_fl_rank").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("_fl_s", F.sum(x * F.pow(F.lit(beta), -p)).over(wl)).withColumn("_fl_p", p)
    local = (1 - beta) * F.pow(F.lit(beta), F.col("_fl_p")) * F.col("_fl_s")
    r = r.withColumn("_fl_local", local)
    # chunk summary: local value at the chunk end and the chunk length
    summ = r.groupBy(*keys, "_fl_chunk").agg(F.max_by("_fl_local", "_fl_rank").alias("_fl_end"),
                                               F.count(F.lit(1)).alias("_fl_len"))
    # carry into chunk c = EMA at the end of chunk c-1
    #   = sum_{j<c} end_j * beta^(before_c - endpos_j).
    # Terms further back than 745 / |ln beta| rows underflow to exactly 0
    # in double precision, so only the previous K chunks contribute: a
    # bounded window frame over the per-chunk summary (linear in chunks).
    lnb = -math.log(beta)
    k_back = int(math.ceil(745.0 / (chunk_rows * lnb))) + 1
    wk = Window.partitionBy(*keys).orderBy("_fl_chunk")
    summ = (summ.withColumn("_fl_endpos", F.sum("_fl_len").over(wk.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_fl_before", F.col("_fl_endpos") - F.col("_fl_len")))
    prev = F.collect_list(F.struct(F.col("_fl_end").alias("e"), F.col("_fl_endpos").alias("p"))) \
        .over(wk.rowsBetween(-k_back, -1))
    summ = summ.withColumn("_fl_prev", prev).withColumn("_fl_carry", F.aggregate(
        "_fl_prev", F.lit(0.0),
        lambda acc, x: acc + x["e"] * F.pow(F.lit(beta), (F.col("_fl_before") - x["p"]).cast("double"))))
    j = r.join(summ.select(*keys, "_fl_chunk", "_fl_carry"), [*keys, "_fl_chunk"])
    e = F.col("_fl_local") + F.col("_fl_carry") * F.pow(F.lit(beta), F.col("_fl_p") + 1)
    if debias:
        e = e / (1 - F.pow(F.lit(beta), F.col("_fl_rank").cast("double")))
    return j.withColumn("ema", e).drop("_fl_s", "_fl_p", "_fl_local", "_fl_carry", "_fl_chunk")


# ---- W06: skip-gram pairs -------------------------------------------------------------
def skipgram_pairs(tokens_df: DataFrame, doc: str, pos: str, token: str, window: int) -> DataFrame:
    """All (centre, context) pairs within ``window`` positions in a document,
    as an equi-join on (doc, pos + offset) – no per-document pair explosion
    beyond the 2*window neighbours of each token."""
    offs = [o for o in range(-window, window + 1) if o != 0]
    centre = tokens_df.select(F.col(doc), F.col(pos).alias("c_pos"), F.col(token).alias("centre"),
                              F.explode(F.array(*[F.lit(o) for o in offs])).alias("offset"))
    centre = centre.withColumn("x_pos", F.col("c_pos") + F.col("offset"))
    ctx = tokens_df.select(F.col(doc), F.col(pos).alias("x_pos"), F.col(token).alias("context"))
    return centre.join(ctx, [doc, "x_pos"]).select(doc, "c_pos", "offset", "centre", "context")


# ---- W07: normalised Gini ----------------------------------------------------------------
def gini_sum(df: DataFrame, actual: str, order_by: Sequence) -> DataFrame:
    """One row: n, sum(actual) and sum_i actual_i * (n - rank_i + 1) (the sum
    of the running totals) for the order ``order_by``. Single pass: each
    range partition reports its count and local weighted sum; ranks are
    offsets from the earlier partitions (no per-row join)."""
    from featlab.operators.ordering import LOCAL_POS_NAME, partition_prefix_aggregate
    a = F.col(actual).cast("double")
    loc = F.col(LOCAL_POS_NAME)
    summ = partition_prefix_aggregate(
        df.select(a.alias("_fl_a"), *[c if isinstance(c, Column) else F.col(c) for c in order_by]),
        order_by, {"_fl_sa": F.sum("_fl_a"), "_fl_sal": F.sum(F.col("_fl_a") * (loc + 1))})
    tot = summ.agg(F.sum("_fl_cnt").alias("n"), F.sum("_fl_sa").alias("sa"),
                   F.sum(F.col("_fl_before") * F.col("_fl_sa") + F.col("_fl_sal")).alias("sar"))
    # sum a*(n - rank + 1) = (n + 1) * sum a - sum a * rank
    return tot.select("n", "sa", ((F.col("n") + 1) * F.col("sa") - F.col("sar")).alias("cum"))


def gini_normalized(df: DataFrame, actual: str, pred: str, id_col: str) -> DataFrame:
    """gini(actual, pred) / gini(actual, actual); order by the score
    descending, ties by id (the input order)."""
    def g(score):
        t = gini_sum(df, actual, [F.col(score).desc(), F.col(id_col).asc()])
        return t.select(((F.col("cum") / F.col("sa") - (F.col("n") + 1) / 2.0) / F.col("n")).alias("g"))
    gp = g(pred).withColumnRenamed("g", "gini")
    ga = g(actual).withColumnRenamed("g", "gini_max")
    from featlab.operators.stats import attach_row
    return attach_row(gp, ga).select("gini", "gini_max", (F.col("gini") / F.col("gini_max")).alias("gini_norm"))


# ---- W11: early stopping on a metric log ---------------------------------------------
def early_stop(log: DataFrame, run_keys: Sequence[str], round_col: str, metric: str,
               patience: int | None = 4, min_rounds: int = 5, lower_is_better: bool = True, no_gain: int | None = None) -> DataFrame:
    """Per run: the best round, and the first round that stops it, if any: the
    metric got worse ``patience`` times in a row after ``min_rounds`` rounds, or
    the best round so far lies more than ``no_gain`` rounds back (None: that
    rule is off). The metric log is small (one row per round), so a window per
    run is fine."""
    w = Window.partitionBy(*run_keys).orderBy(round_col)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    prev = F.lag(metric).over(w)
    worse = (F.col(metric) > prev) if lower_is_better else (F.col(metric) < prev)
    x = log.withColumn("_fl_worse", F.coalesce(worse, F.lit(False)).cast("int"))
    # length of the current run of "worse" rounds: rounds since last non-worse
    x = x.withColumn("_fl_grp", F.sum(1 - F.col("_fl_worse")).over(upto))
    x = x.withColumn("_fl_streak", F.sum("_fl_worse").over(
        Window.partitionBy(*run_keys, "_fl_grp").orderBy(round_col).rowsBetween(Window.unboundedPreceding, 0)))
    stops = F.lit(False)
    if patience is not None:
        stops = stops | ((F.col("_fl_streak") >= patience) & (F.col(round_col) > min_rounds))
    signed = F.col(metric) if lower_is_better else -F.col(metric)
    if no_gain is not None:
        x = x.withColumn("_fl_best", F.min_by(F.col(round_col), F.struct(signed, F.col(round_col))).over(upto))
        stops = stops | (F.col(round_col) - F.col("_fl_best") > no_gain)
    stop = x.filter(stops).groupBy(*run_keys).agg(F.min(round_col).alias("stop_round"))
    best = log.groupBy(*run_keys).agg(F.min_by(F.col(round_col), F.struct(signed, F.col(round_col))).alias("best_round"),
                                      F.count(F.lit(1)).alias("rounds"))
    return best.join(stop, list(run_keys), "left")
