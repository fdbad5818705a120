"""Queries of histogram boosting."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.operators import boosting as B
from featlab.operators.folds import hash_fold
from featlab.plans.models_q import _doc_features
from featlab.plans.registry import query
from featlab.session import written_table
from featlab.sources.tables import read_table

R = 6
FEATURES = ["log_chars", "word_rate", "digit_rate"]


@query("m01_boosted_split", """
WITH base AS (SELECT avg(l_extendedprice) AS b, sum(l_extendedprice * l_extendedprice) - count(*) * avg(l_extendedprice) * avg(l_extendedprice) AS v FROM lineitem),
r AS (SELECT l_quantity, l_discount, l_tax, b - l_extendedprice AS g FROM lineitem, base),
long AS (SELECT 0 AS f, 'l_quantity' AS feature, l_quantity AS x, g FROM r UNION ALL SELECT 1, 'l_discount', l_discount, g FROM r UNION ALL SELECT 2, 'l_tax', l_tax, g FROM r),
h AS (SELECT f, feature, x, sum(g) AS g, count(*) AS n FROM long GROUP BY ALL),
c AS (SELECT *, sum(g) OVER upto AS gl, sum(n) OVER upto AS nl, sum(g) OVER whole AS gt, sum(n) OVER whole AS nt FROM h
      WINDOW upto AS (PARTITION BY f ORDER BY x), whole AS (PARTITION BY f)),
t AS (SELECT *, greatest(abs(gl) - 1000, 0) AS tl, greatest(abs(gt - gl) - 1000, 0) AS tr, greatest(abs(gt) - 1000, 0) AS tt FROM c WHERE nl >= 50 AND nt - nl >= 50),
s AS (SELECT *, tl * tl / (nl + 10) + tr * tr / (nt - nl + 10) - tt * tt / (nt + 10) AS gain FROM t)
SELECT feature, x AS threshold, round(gain / v, 6) AS gain_share, nl::BIGINT AS n_left, (nt - nl)::BIGINT AS n_right,
       round(-sign(gl) * tl / (nl + 10), 4) AS left_value, round(-sign(gt - gl) * tr / (nt - nl + 10), 4) AS right_value
FROM s, base ORDER BY gain DESC, f, x LIMIT 1
""")
def m01_boosted_split(spark, sf_dir):
    """The first split of a boosted regression of the price, with both penalties."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    p = B.BoostParams(max_depth=1, learning_rate=1.0, lambda_l1=1000.0, lambda_l2=10.0, min_data_in_leaf=50)
    ids, features = ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"]
    model, bins = B.fit(li, features, "l_extendedprice", ids, p, 1)
    split = B.trees_table(spark, model, bins).filter("node = 0").select("feature", "threshold", "left", "right")
    leaves = B.trees_table(spark, model, bins).filter("feature is null").select("node", "value")
    scored = B.predict(li, model, bins, ids).select(F.round(F.col("score")[0] - model.base[0], 4).alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    spread_ = li.agg((F.sum(F.col("l_extendedprice") ** 2) - F.count(F.lit(1)) * F.avg("l_extendedprice") ** 2).alias("v"))
    left = leaves.select(F.col("node").alias("left"), F.round("value", 4).alias("left_value"))
    right = leaves.select(F.col("node").alias("right"), F.round("value", 4).alias("right_value"))
    n_left = scored.select(F.col("leaf").alias("left_value"), F.col("n").alias("n_left"))
    n_right = scored.select(F.col("leaf").alias("right_value"), F.col("n").alias("n_right"))
    # the gain follows from the leaf values: S = T^2 / (n + 10) = value^2 (n + 10); the root's T is 0
    gain = F.col("left_value_") ** 2 * (F.col("n_left") + 10) + F.col("right_value_") ** 2 * (F.col("n_right") + 10)
    exact = leaves.select(F.round("value", 4).alias("left_value"), F.col("value").alias("left_value_")), \
        leaves.select(F.round("value", 4).alias("right_value"), F.col("value").alias("right_value_"))
    return split.join(left, "left").join(right, "right").join(n_left, "left_value").join(n_right, "right_value") \
        .join(exact[0], "left_value").join(exact[1], "right_value").crossJoin(F.broadcast(spread_)) \
        .select("feature", "threshold", F.round(gain / F.col("v"), R).alias("gain_share"), "n_left", "n_right", "left_value", "right_value")


@query("m01_boosted_classes")
def m01_boosted_classes(spark, sf_dir):
    """Softmax boosting of the language from text features: class and probability of every document."""
    langs = ["de", "en", "es", "fr"]
    docs = _doc_features(spark, sf_dir).join(read_table(spark, sf_dir, "documents", "doc_id", "lang", "text"), "doc_id") \
        .withColumn("y", F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1) \
        .withColumn("y", F.when(F.col("y") >= 0, F.col("y"))) \
        .withColumn("marks", F.length(F.regexp_replace("text", r"[^À-ɏ]", "")) / F.greatest(F.length("text"), F.lit(1))) \
        .withColumn("th", F.size(F.split("text", "th")) / F.greatest(F.length("text"), F.lit(1)))
    docs = written_table(docs.select("doc_id", "y", *FEATURES, "marks", "th"))   # fits and scores do not read the texts again
    p = B.BoostParams(objective="softmax", classes=len(langs), max_depth=3, learning_rate=0.4, lambda_l2=1.0, min_data_in_leaf=5)
    features = [*FEATURES, "marks", "th"]
    model, bins = B.fit(docs, features, "y", ["doc_id"], p, 6, max_bin=63)
    probs = F.transform("score", lambda x: F.round(x, R))
    best = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("score", F.array_max("score")).cast("int"))
    return B.predict(docs, model, bins, ["doc_id"]).select("doc_id", best.alias("lang"), probs.alias("probabilities"))


@query("m02_boosted_cv")
def m02_boosted_cv(spark, sf_dir):
    """Mean absolute error per fold and round, training and held out, of L1 boosting over all documents."""
    docs = _doc_features(spark, sf_dir).withColumn("fold", hash_fold("doc_id", 3))
    bins = B.fit_bins(docs, FEATURES, 63)
    models = [B.Model(B.BoostParams(objective="l1", max_depth=3, min_data_in_leaf=5), f) for f in range(3)]
    log = B.train(B.binned(docs, bins, ["doc_id"], "lines", "fold"), bins, models, 12, patience=5, groups=[0, 0, 0])
    return spark.createDataFrame([(k, r, round(a, R), round(b, R)) for k, r, a, b in log], "fold int, round int, train_mae double, valid_mae double")


@query("m03_boosted_tuning")
def m03_boosted_tuning(spark, sf_dir):
    """Depth, child weight, row and column fractions, penalties and minimum gain, tuned group after group."""
    docs = _doc_features(spark, sf_dir).withColumn("fold", hash_fold("doc_id", 3))
    base = B.BoostParams(learning_rate=0.3, min_data_in_leaf=20)
    _, _, log = B.tune(docs, FEATURES, "lines", ["doc_id"], "fold", base, rounds=4, max_bin=31)
    return log.withColumn("loss", F.round("loss", R))


@query("m10_boosted_refit")
def m10_boosted_refit(spark, sf_dir):
    """Train on two folds, take the best round, then go on with all rows until the training loss of that round is reached."""
    docs = _doc_features(spark, sf_dir).withColumn("fold", hash_fold("doc_id", 3))
    bins = B.fit_bins(docs, FEATURES, 63)
    model = B.Model(B.BoostParams(max_depth=3, learning_rate=0.3, min_data_in_leaf=5), held_out=0)
    log = B.train(B.binned(docs, bins, ["doc_id"], "lines", "fold"), bins, [model], 8)
    best = min(log[1:], key=lambda x: (x[3], x[1]))
    went = B.continue_until(docs, model.first(best[1]), bins, "lines", ["doc_id"], target=best[2], most=20)
    rows = [("train", r, round(a, R), round(b, R)) for _, r, a, b in log] + [("refit", r, round(a, R), None) for r, a in went]
    return spark.createDataFrame(rows, "part string, round int, train_loss double, valid_loss double")
