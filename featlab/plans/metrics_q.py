"""Queries for evaluation metrics on ``labels`` x ``documents``.

The score is a fixed, data-derived function of the document length (a
stand-in model), so the metrics exercise the same code paths as real
predictions do.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.operators import metrics as M
from featlab.operators.folds import kfold
from featlab.plans.registry import query
from featlab.sources.tables import read_table

R = 6

_SQL_SCORED = """
SELECT l.doc_id, l.quality AS y, l.quality + 2 * l.toxic AS cls,
       1 / (1 + exp(-(ln(d.n_chars) - 7.5))) AS p,
       CASE WHEN 1 / (1 + exp(-(ln(d.n_chars) - 7.5))) > 0.5 THEN 1 ELSE 0 END AS pred,
       CAST(least(3, greatest(0, floor(ln(d.n_chars)) - 5)) AS INTEGER) AS pred_cls
FROM labels l JOIN documents d USING (doc_id)
"""


def _scored(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "n_chars")
    p = 1 / (1 + F.exp(-(F.log("n_chars") - 7.5)))
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), (F.col("quality") + 2 * F.col("toxic")).alias("cls"),
        p.alias("p"), F.when(p > 0.5, 1).otherwise(0).alias("pred"),
        F.least(F.lit(3), F.greatest(F.lit(0), F.floor(F.log("n_chars")) - 5)).cast("int").alias("pred_cls"))


@query("a22_confusion_matrix", f"""
WITH s AS ({_SQL_SCORED}) SELECT cls AS label, pred_cls AS pred, count(*) AS count FROM s GROUP BY 1, 2
""")
def a22_confusion_matrix(spark, sf_dir):
    return M.confusion(_scored(spark, sf_dir), "cls", "pred_cls")


@query("a23_p14_per_class_prf", f"""
WITH s AS ({_SQL_SCORED}),
c AS (SELECT cls AS label, pred_cls AS pred, count(*) AS n FROM s GROUP BY 1, 2),
k AS (SELECT label AS cls FROM c UNION SELECT pred FROM c),
t AS (SELECT k.cls, coalesce((SELECT sum(n) FROM c WHERE c.label = k.cls AND c.pred = k.cls), 0) AS tp,
             coalesce((SELECT sum(n) FROM c WHERE c.pred = k.cls), 0) AS n_pred,
             coalesce((SELECT sum(n) FROM c WHERE c.label = k.cls), 0) AS support FROM k),
r AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred END AS precision,
                CASE WHEN support > 0 THEN tp / support END AS recall FROM t)
SELECT cls, CAST(tp AS BIGINT) AS tp, CAST(n_pred AS BIGINT) AS n_pred, CAST(support AS BIGINT) AS support,
       round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) END, 6) AS f1
FROM r
""")
def a23_p14_per_class_prf(spark, sf_dir):
    pc = M.per_class(_scored(spark, sf_dir), "cls", "pred_cls")
    return pc.select("cls", *[F.col(c).cast("bigint").alias(c) for c in ("tp", "n_pred", "support")],
                     *[F.round(c, R).alias(c) for c in ("precision", "recall", "f1")])


@query("a24_macro_f1_hits_only", f"""
WITH s AS ({_SQL_SCORED}),
t AS (SELECT c AS cls, (SELECT count(*) FROM s WHERE cls = c AND pred_cls = c) AS tp,
             (SELECT count(*) FROM s WHERE pred_cls = c) AS np, (SELECT count(*) FROM s WHERE cls = c) AS nl
      FROM (SELECT cls AS c FROM s UNION SELECT pred_cls FROM s))
SELECT round(avg(2 * (tp / np) * (tp / nl) / ((tp / np) + (tp / nl))), 6) AS macro_f1 FROM t WHERE tp > 0
""")
def a24_macro_f1_hits_only(spark, sf_dir):
    return M.macro_f1(_scored(spark, sf_dir), "cls", "pred_cls").select(F.round("macro_f1", R).alias("macro_f1"))


@query("a25_scores", f"""
WITH s AS ({_SQL_SCORED}),
g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
auc AS (SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM c)
SELECT round(avg(abs(y - p)), 6) AS mae, round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2,
       round(avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(-(y * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - y) * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)))), 6) AS log_loss,
       round(any_value(auc.auc), 6) AS auc
FROM s, auc
""")
def a25_scores(spark, sf_dir):
    s = _scored(spark, sf_dir)
    reg = M.regression_metrics(s, "y", "p")
    out = M.attach_row(M.attach_row(M.attach_row(reg, M.accuracy(s, "y", "pred")), M.log_loss(s, "y", "p")),
                       M.auc(s, "y", "p"))
    return out.select(*[F.round(c, R).alias(c) for c in ("mae", "r2", "accuracy", "log_loss", "auc")])


@query("a26_best_threshold", f"""
WITH s AS ({_SQL_SCORED}),
t AS (SELECT i, i / 100.0 AS thr FROM range(0, 100) r(i)),
f AS (SELECT i, thr, count(*) FILTER (WHERE p > thr AND y = 1) AS tp, count(*) FILTER (WHERE p > thr) AS pp,
             (SELECT count(*) FROM s WHERE y = 1) AS pos FROM t, s GROUP BY i, thr),
g AS (SELECT i, thr, CASE WHEN tp > 0 THEN 2 * tp / (pp + pos) ELSE 0.0 END AS f1 FROM f)
SELECT CASE WHEN max(f1) > 0 THEN arg_max(thr, (f1, -i)) ELSE 0.5 END AS threshold, round(max(f1), 6) AS f1 FROM g
""")
def a26_best_threshold(spark, sf_dir):
    b = M.best_threshold(_scored(spark, sf_dir), "y", "p")
    return b.select("threshold", F.round("f1", R).alias("f1"))


@query("a27_cv_mean_std", f"""
WITH s AS (SELECT *, ntile(5) OVER (ORDER BY doc_id) - 1 AS fold FROM ({_SQL_SCORED})),
f AS (SELECT fold, avg(abs(y - p)) AS mae FROM s GROUP BY fold)
SELECT round(avg(mae), 6) AS mean, round(stddev_pop(mae), 6) AS std, count(fold) AS folds FROM f
""")
def a27_cv_mean_std(spark, sf_dir):
    s = kfold(_scored(spark, sf_dir), ["doc_id"], 5)
    per = s.groupBy("fold").agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"))
    c = M.cv_summary(per, "fold", "mae")
    return c.select(F.round("mean", R).alias("mean"), F.round("std", R).alias("std"), "folds")


@query("r06_best_round", """
WITH log AS (SELECT event_type, CAST(date_diff('hour', TIMESTAMP '2024-01-01', ts) // 24 AS BIGINT) AS round,
                    avg(value) AS metric FROM events GROUP BY 1, 2)
SELECT event_type, arg_min(round, (metric, round)) AS best_round, round(min(metric), 6) AS best_metric FROM log GROUP BY 1
""")
def r06_best_round(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "ts", "event_type", "value")
    log = e.groupBy("event_type", F.floor(
        (F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 86400
    ).cast("bigint").alias("round")).agg(F.avg("value").alias("metric"))
    b = M.best_round(log, ["event_type"], "round", "metric")
    return b.select("event_type", "best_round", F.round("best_metric", R).alias("best_metric"))
