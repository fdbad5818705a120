"""Small tables sent to large ones, texts read once, top-k that sorts only what reaches the bound."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featlab.operators import fits as FT
from featlab.operators import models as MD
from featlab.operators import vectors as V


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("robust", [False, True])
def test_rows_of_few_facets_are_not_joined_by_a_shuffle(spark, monkeypatch, robust):
    seen, plain = [], FT._moments
    monkeypatch.setattr(FT, "_moments", lambda rows, *a: seen.append(plan(rows)) or plain(rows, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(400).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + F.col("id") % 2).alias("y"))
        got = {r.g: r for r in FT.fitted_polynomials(rows, "y", "x", ["g"], robust=robust).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen and not any("SortMergeJoin" in p for p in seen)
    assert {g: r.n for g, r in got.items()} == {0: 200, 1: 200} and all(abs(r.coefficients[1] - 3) < 1e-9 and abs(r.coefficients[0] - g) < 1e-6 for g, r in got.items())


def test_second_order_sums_factors_in_one_aggregation(spark):
    index = spark.createDataFrame([(1, 0, 1.0), (1, 2, 2.0), (2, 0, 1.0), (2, 9, 1.0), (3, 9, 1.0), (4, 1, 1.0)], "s long, idx long, value double")
    w = spark.createDataFrame([(0, [1.0, 2.0]), (2, [3.0, -1.0]), (1, None)], "idx long, vec array<double>")
    out = V.fm_second_order(index, w, "s", 2)
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert {r.s: r.fm2 for r in out.collect()} == {1: 1 * 6.0 + 2 * -2.0, 2: 0.0}


def test_merged_keeps_what_a_full_sort_keeps():
    rng = np.random.default_rng(3)
    for _ in range(200):
        k, n, have, m = rng.integers(1, 6), rng.integers(1, 7), rng.integers(0, 6), rng.integers(1, 20)
        have = min(have, k)
        best_s, s = -np.sort(-rng.integers(-2, 3, (n, have)).astype(float), axis=1), rng.integers(-2, 3, (n, m)).astype(float)
        s[rng.random((n, m)) < .2] = -np.inf
        best_i, cid = np.tile(np.arange(100, 100 + have), (n, 1)), rng.permutation(m)
        width = min(k, have + m)
        all_s, all_i = np.concatenate([best_s, s], axis=1), np.concatenate([best_i, np.broadcast_to(cid, (n, m))], axis=1)
        order = np.lexsort((all_i, -all_s), axis=1)[:, :width]
        got = V._merged(best_s, best_i, s, cid, k, width)
        assert (got[0] == np.take_along_axis(all_s, order, 1)).all() and (got[1] == np.take_along_axis(all_i, order, 1)).all()


def test_document_features_are_written_and_texts_not_read_again(spark, tmp_path):
    from featlab.plans import models_q as Q
    spark.createDataFrame([(1, "a 1\nb22"), (2, None), (3, "")], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = Q._doc_features(spark, str(tmp_path))
    assert docs.inputFiles() and not any("documents.parquet" in f for f in docs.inputFiles())
    got = {r.doc_id: r for r in docs.collect()}
    assert got[1].lines == 2.0 and abs(got[1].digit_rate - 3 / 7) < 1e-12 and got[2].lines is None and got[3].lines == 1.0 and got[1].quality == 1


def test_hashed_terms_and_classifier_are_the_text_classifier(spark):
    rows = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["c", "d", "a"], float(i % 2)) for i in range(20)], "id long, tok array<string>, label double")
    one = MD.text_classifier("tok", "label", 64).fit(rows).transform(rows)
    hashed = MD.hashed_terms("tok", 64).transform(rows)
    two = MD.term_classifier("label").fit(hashed).transform(hashed)
    assert [r.probability for r in one.orderBy("id").collect()] == [r.probability for r in two.orderBy("id").collect()]
