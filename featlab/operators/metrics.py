"""Evaluation metrics as aggregations.

All metrics are one or two aggregation passes over ``(label, prediction)``
rows; per-class tables are tiny (classes x classes). AUC groups rows by
score first and takes the running count of negatives over the (aggregated)
distinct scores with the hot-key-safe cumulative sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.functions.scalar import f_score
from featlab.operators.sequential import cumulative_sum
from featlab.operators.stats import attach_row


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, pred, count) for the pairs that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("count"))


def per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class (P14 for F1;
    undefined ratios are NULL)."""
    c = confusion(df, label, pred)
    hits = c.filter(F.col("label") == F.col("pred")).select(F.col("label").alias("cls"), F.col("count").alias("tp"))
    by_pred = c.groupBy(F.col("pred").alias("cls")).agg(F.sum("count").alias("n_pred"))
    by_label = c.groupBy(F.col("label").alias("cls")).agg(F.sum("count").alias("support"))
    t = by_label.join(by_pred, "cls", "full").join(hits, "cls", "left").fillna(0, ["tp", "n_pred", "support"])
    p = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred"))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support"))
    return (t.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", f_score("precision", "recall"))
            .select("cls", "tp", "n_pred", "support", "precision", "recall", "f1"))


def macro_f1(df: DataFrame, label: str, pred: str, hits_only: bool = True) -> DataFrame:
    """Mean F1 over classes; with ``hits_only`` only classes predicted
    correctly at least once count (others would contribute 0)."""
    pc = per_class(df, label, pred)
    if hits_only:
        pc = pc.filter(F.col("tp") > 0)
    return pc.agg(F.avg(F.coalesce(F.col("f1"), F.lit(0.0))).alias("macro_f1"))


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """MAE, RMSE and R^2 = 1 - SSE / SST in one pass."""
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    return df.agg(F.avg(F.abs(yy - pp)).alias("mae"),
                  F.sqrt(F.avg((yy - pp) * (yy - pp))).alias("rmse"),
                  (1 - F.sum((yy - pp) * (yy - pp)) / (F.count(yy) * F.var_pop(yy))).alias("r2"))


def log_loss(df: DataFrame, y: str, p: str, eps: float = 1e-15) -> DataFrame:
    """Binary log-loss with probabilities clipped to [eps, 1 - eps]."""
    pr = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return df.agg(F.avg(-(yy * F.log(pr) + (1 - yy) * F.log(1 - pr))).alias("log_loss"))


def accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """ROC AUC by ranks with ties counted half:
    sum over scores of pos(s) * (neg below s + neg(s) / 2) / (P * N)."""
    g = df.groupBy(F.col(score).alias("s")).agg(F.sum(F.col(y).cast("double")).alias("pos"),
                                                  F.sum(1 - F.col(y).cast("double")).alias("neg"))
    c = cumulative_sum(g, [], ["s"], "neg")     # distributed prefix over the distinct scores
    return c.agg((F.sum(F.col("pos") * (F.col("cumsum_excl") + F.col("neg") / 2))
                  / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def best_threshold(df: DataFrame, y: str, p: str, steps: int = 100) -> DataFrame:
    """F1 of ``pred = p > t`` for t = 0, 1/steps, ...; the first t with
    the highest F1 wins (0.5 when every F1 is 0). One aggregation pass."""
    yy = F.col(y) == 1
    aggs = [F.count_if(yy).alias("pos")]
    for t in range(steps):
        thr = t / steps
        aggs += [F.count_if((F.col(p) > thr) & yy).alias(f"tp{t}"), F.count_if(F.col(p) > thr).alias(f"pp{t}")]
    row = df.agg(*aggs)
    st = [F.struct(F.lit(t / steps).alias("t"),
                   F.when(F.col(f"tp{t}") > 0, 2 * F.col(f"tp{t}") / (F.col(f"pp{t}") + F.col("pos")))
                   .otherwise(0.0).alias("f1")) for t in range(steps)]
    long = row.select(F.posexplode(F.array(*st)).alias("k", "x")).select("k", "x.t", "x.f1")
    best = long.agg(F.max_by(F.struct("t", "f1"), F.struct(F.col("f1"), -F.col("k"))).alias("b"))
    return best.select(F.when(F.col("b.f1") > 0, F.col("b.t")).otherwise(0.5).alias("threshold"),
                       F.col("b.f1").alias("f1"))


def cv_summary(scores: DataFrame, fold_col: str, metric: str) -> DataFrame:
    """Mean and population std of a per-fold metric."""
    return scores.agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"),
                      F.count(fold_col).alias("folds"))


def weighted_mean(df: DataFrame, value: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Batch-weighted mean sum(v * n) / sum(n)."""
    return df.groupBy(*by).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("weighted_mean"))


def best_round(log: DataFrame, keys: Sequence[str], round_col: str, metric: str, minimize: bool = True) -> DataFrame:
    """Round with the best metric (ties: earliest round)."""
    fn = F.min_by if minimize else F.max_by
    key = F.struct(F.col(metric), F.col(round_col)) if minimize else F.struct(F.col(metric), -F.col(round_col))
    return log.groupBy(*keys).agg(fn(F.col(round_col), key).alias("best_round"),
                                  (F.min if minimize else F.max)(metric).alias("best_metric"))


__all__ = ["confusion", "per_class", "macro_f1", "regression_metrics", "log_loss", "accuracy", "auc",
           "best_threshold", "cv_summary", "weighted_mean", "best_round", "attach_row"]
