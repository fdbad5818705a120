"""Queries of row reductions, filled segments, tag filters, general dates,
marginals, class rows and forest grids, over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.functions import dates as D
from featlab.functions import text as T
from featlab.functions.arrays import explode_values, to_double_array
from featlab.operators import models as MD
from featlab.operators import plotdata as G
from featlab.operators import stats as ST
from featlab.operators import vocab as V
from featlab.operators.folds import kfold
from featlab.operators.linear_paths import stepwise_linear
from featlab.operators.mean_encoding import MeanEncoder
from featlab.plans import misc, tabular  # noqa: F401  their SQL is part of two queries here
from featlab.plans.registry import ORACLE, query
from featlab.sources.tables import read_table

R = 6


@query("a01_row_reductions", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT vec_id, round(list_sum(e), 6) + 0.0 AS sum, round(list_avg(e), 6) + 0.0 AS mean, round(list_max(e), 6) + 0.0 AS max, round(list_min(e), 6) + 0.0 AS min,
  round(list_product(list_transform(e, lambda x: 1 + x)), 6) + 0.0 AS prod, len(list_filter(e, lambda x: x <> 0)) AS count_nonzero,
  len(list_filter(e, lambda x: x = 0)) = 0 AS "all", len(list_filter(e, lambda x: x <> 0)) > 0 AS "any"
FROM v
""")
def a01_row_reductions(spark, sf_dir):
    e = to_double_array(F.col("embedding"))
    of = ST.reduce_row(e)
    of["prod"] = ST.reduce_row(F.transform(e, lambda x: 1 + x))["prod"]
    rounded = [(F.round(of[n], R) + 0.0).alias(n) for n in ("sum", "mean", "max", "min", "prod")]
    return read_table(spark, sf_dir, "embeddings", "vec_id", "embedding").select("vec_id", *rounded, *[of[n].alias(n) for n in ("count_nonzero", "all", "any")])


@query("a04_filled_segments", """
WITH s AS (SELECT p_partkey % 97 AS seg, count(l_quantity) AS c, sum(l_quantity) AS s, max(l_quantity) AS x, min(l_quantity) AS m, product(1 + l_tax / 100) AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 1 GROUP BY 1)
SELECT g.seg, round(coalesce(s.s, 0), 6) AS sum, round(coalesce(s.s / s.c, 0), 6) AS mean, coalesce(s.x, 0) AS max, coalesce(s.m, 0) AS min, round(coalesce(s.p, 1), 6) AS prod
FROM (SELECT unnest(generate_series(0, 96)) AS seg) g LEFT JOIN s USING (seg)
""")
def a04_filled_segments(spark, sf_dir):
    """Quantity by part number modulo 97 over parts of size 1, every segment filled."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size").filter("p_size = 1")
    rows = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_tax").join(p, F.col("l_partkey") == F.col("p_partkey")) \
        .select((F.col("p_partkey") % 97).alias("seg"), "l_quantity", (1 + F.col("l_tax") / 100).alias("t"))
    q, t = ST.segment_reduce(rows, "seg", "l_quantity", 97).drop("prod"), ST.segment_reduce(rows, "seg", "t", 97).select("seg", "prod")
    return q.join(t, "seg").select("seg", *[F.round(c, R).alias(c) for c in ("sum", "mean", "max", "min", "prod")])


@query("p11_tagged_words", f"""
WITH w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS term FROM documents),
tags AS (SELECT term, arg_min(lang, (-n, lang)) AS tag FROM (SELECT term, lang, count(*) AS n FROM w GROUP BY 1, 2) GROUP BY term),
stop AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS term FROM benchmark)
SELECT doc_id, term, count(*) AS n FROM w
WHERE length(term) > 1 AND term NOT IN (FROM stop) AND term IN (SELECT term FROM tags WHERE tag LIKE 'e%') GROUP BY 1, 2
""")
def p11_tagged_words(spark, sf_dir):
    """Words of the documents that are no word of ``benchmark`` and whose tag
    (the word's most frequent language) starts with "e"."""
    words = read_table(spark, sf_dir, "documents", "doc_id", "lang", "text") \
        .select("doc_id", "lang", explode_values(T.word_tokens("text")).alias("term")).filter(F.col("term").isNotNull())
    tags = (words.groupBy("term", "lang").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("term").agg(F.min_by("lang", F.struct(-F.col("n"), F.col("lang"))).alias("tag")))
    stop = V.word_rows(read_table(spark, sf_dir, "benchmark", "text"), T.word_tokens("text"))
    return V.keep_words(words, "term", stop, tags, prefix="e").groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


_FORMS = ("'Order of' EEEE, MMMM d, yyyy 'at' h:mm a", "d MMM yyyy HH:mm:ss", "M/d/yyyy h:mm:ss a", "yyyy.MM.dd 'time' HH:mm", "dd-MMM-yy HH:mm", "'ref' yyyyMMdd'T'HHmmss")


@query("x21_general_dates", """
SELECT event_id, strftime(CASE event_id % 6 WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('second', ts) WHEN 5 THEN date_trunc('second', ts)
  ELSE date_trunc('minute', ts) END, '%Y-%m-%d %H:%M:%S') AS parsed FROM events
""")
def x21_general_dates(spark, sf_dir):
    """Event times written in six ways (by id) and read back; the reference time is 2024-06-01."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    text = F.lit(None).cast("string")
    for k, form in enumerate(_FORMS):
        text = F.when(F.col("event_id") % 6 == k, F.date_format("ts", form)).otherwise(text)
    read = D.general_datetime(text, F.lit("2024-06-01").cast("timestamp"))
    return e.select("event_id", F.date_format(read, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("g09_joint_marginals", f"""
WITH b AS ({ORACLE["g09_joint_bins"]})
SELECT 'x' AS axis, bx AS bin, CAST(sum(count) AS BIGINT) AS count FROM b GROUP BY 2 UNION ALL SELECT 'y', "by", CAST(sum(count) AS BIGINT) FROM b GROUP BY 2
""")
def g09_joint_marginals(spark, sf_dir):
    return G.joint_marginals(G.joint_bins(read_table(spark, sf_dir, "lineitem", "l_quantity", "l_discount"), "l_quantity", "l_discount", 5))


@query("e12_class_rows", f"""
WITH wide AS ({ORACLE["e12_oof_mean_encoding_classes"]})
SELECT o_orderkey AS id, 'F' AS "class", o_orderpriority_pred_F AS value FROM wide UNION ALL
SELECT o_orderkey, 'O', o_orderpriority_pred_O FROM wide UNION ALL SELECT o_orderkey, 'P', o_orderpriority_pred_P FROM wide
""")
def e12_class_rows(spark, sf_dir):
    """Out-of-fold class shares as one row per (order, class): no class list is collected."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    enc = MeanEncoder(["o_orderpriority"], "o_orderstatus", id_col="o_orderkey", target_type="classification")
    return enc.classification_long(o, "o_orderpriority").select("id", "class", F.round("value", R).alias("value"))


@query("m07_forest_grid")
def m07_forest_grid(spark, sf_dir):
    """Forests over a grid of depth and number of trees: AUC of document
    quality and mean absolute error of the line count, three folds by id."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
    from featlab.plans.models_q import _doc_features
    docs = MD.assemble_for_trees(_doc_features(spark, sf_dir), ["log_chars", "word_rate", "digit_rate"])
    known = docs.filter(F.col("quality").isNotNull()).withColumn("label", F.col("quality").cast("double"))
    lines = MD.with_label(docs.withColumn("label", F.col("lines").cast("double")))
    grid, names, out = {"maxDepth": [2, 5], "numTrees": [5, 20]}, ["maxDepth", "numTrees"], None
    for goal, kind, rows, ev in (("auc", "binary", known, BinaryClassificationEvaluator()), ("mae", "regression", lines, RegressionEvaluator(metricName="mae"))):
        folded = kfold(rows, ["doc_id"], 3).withColumn("fold", F.col("fold").cast("int"))
        cv = MD.grid_search(MD.random_forest(kind, seed=42), grid, ev, fold_col="fold").fit(folded)
        part = MD.grid_table(spark, cv, names).select(F.lit(goal).alias("goal"), *names, F.round("score", R).alias("score"), "best")
        out = part if out is None else out.unionByName(part)
    return out


_FEATURES = ["log_chars", "word_rate", "digit_rate"]


@query("f03_f07_f08_feature_rankings")
def f03_f07_f08_feature_rankings(spark, sf_dir):
    """Every text feature's score alone, impurity importance and permutation
    importance (5 hold-outs) for the line count of all documents."""
    from featlab.plans.models_q import _doc_features
    docs = _doc_features(spark, sf_dir).select("doc_id", "lines", *_FEATURES)   # written: the texts are read once
    alone = MD.single_feature_ranking(docs, _FEATURES, "lines", "doc_id", splits=2)
    shuffled = MD.permutation_importance(docs, _FEATURES, "lines", "doc_id", splits=5)
    impurity = spark.createDataFrame(list(MD.impurity_importance(docs, _FEATURES, "lines").items()), "feature string, impurity double")
    return alone.join(shuffled, "feature").join(impurity, "feature") \
        .select("feature", F.round("score", R).alias("score"), F.round("importance", R).alias("importance"), F.round("impurity", R).alias("impurity"))


@query("f12_first_linear_step", """
WITH b AS (SELECT CAST(o_totalprice AS DOUBLE) AS y, o_orderkey % 5 AS fold, CAST(o_totalprice > 150000 AS DOUBLE) AS f FROM orders),
s AS (SELECT fold, count(*) AS n, sum(y) AS y, sum(y * y) AS yy, sum(f) AS f, sum(f * y) AS fy, sum(f * y * y) AS fyy FROM b GROUP BY 1),
t AS (SELECT sum(n) AS n, sum(y) AS y, sum(f) AS f, sum(fy) AS fy FROM s),
m AS (SELECT s.*, (t.y - s.y) / (t.n - s.n) AS all_mean, (t.fy - s.fy) / (t.f - s.f) AS m1, (t.y - s.y - t.fy + s.fy) / (t.n - s.n - t.f + s.f) AS m0 FROM s, t),
e AS (SELECT avg((yy - 2 * all_mean * y + n * all_mean * all_mean) / n) AS e0,
  avg((yy - 2 * (m1 * fy + m0 * (y - fy)) + m1 * m1 * f + m0 * m0 * (n - f)) / n) AS e1 FROM m)
SELECT CAST(0 AS BIGINT) AS step, '' AS feature, round(sqrt(e0), 3) AS error FROM e UNION ALL SELECT 1, 'f', round(sqrt(e1), 3) FROM e WHERE e1 <= e0
""")
def f12_first_linear_step(spark, sf_dir):
    """Forward selection over one two-valued feature of the orders (oracle: errors of the group means)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice") \
        .select((F.col("o_orderkey") % 5).cast("int").alias("fold"), (F.col("o_totalprice") > 150000).cast("double").alias("f"), F.col("o_totalprice").cast("double").alias("y"))
    log = [(step, name, error ** 0.5) for step, name, error in stepwise_linear(o, ["f"], "y", "fold")]
    return spark.createDataFrame(log, "step bigint, feature string, error double").select("step", "feature", F.round("error", 3).alias("error"))


@query("f11_f12_linear_stepwise")
def f11_f12_linear_stepwise(spark, sf_dir):
    """Backward and forward selection of price features by the error over five folds of the line items."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    rows = li.select((F.col("l_orderkey") % 5).cast("int").alias("fold"), *[F.col(c).cast("double").alias(c) for c in li.columns[1:]])
    both = [(name, *step) for name, way in (("forward", True), ("backward", False))
            for step in stepwise_linear(rows, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "fold", way)]
    return spark.createDataFrame(both, "way string, step bigint, feature string, error double").withColumn("error", F.round("error", 3))
