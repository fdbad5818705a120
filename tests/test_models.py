"""Model wrappers: regulariser scaling against closed forms, sanity checks."""

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from featlab.operators import models as MD


def _data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    y = X @ np.array([2.0, -1.0, 0.0]) + 0.5 + rng.normal(scale=0.3, size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": y})
    return spark.createDataFrame(pdf), X, y


def test_ridge_matches_closed_form(spark):
    df, X, y = _data(spark)
    alpha = 10.0
    x = MD.assemble(df, ["a", "b", "c"]).withColumn("label", F.col("y"))
    m = MD.ridge(alpha, len(y), float(np.std(y))).fit(x)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    np.testing.assert_allclose(m.coefficients.toArray(), w, atol=1e-6)


def test_gram_lasso_matches_mllib(spark):
    df, X, y = _data(spark)
    alpha = 0.3
    # standardised features, centered label: both solve 1/(2n)||y - Xw||^2 + alpha ||w||_1
    Z = (X - X.mean(0)) / X.std(0)
    yc = y - y.mean()
    w_cd = MD.lasso_cd(Z.T @ Z, Z.T @ yc, len(y), alpha, iters=2000)
    pdf = pd.DataFrame({"a": Z[:, 0], "b": Z[:, 1], "c": Z[:, 2], "label": yc})
    m = MD.lasso(alpha).setFitIntercept(False).fit(MD.assemble(spark.createDataFrame(pdf), ["a", "b", "c"]))
    np.testing.assert_allclose(m.coefficients.toArray(), w_cd, atol=1e-4)
    assert w_cd[2] == 0.0


def test_linear_weights_and_rfe(spark):
    df, X, y = _data(spark)
    w = MD.linear_weights(df, ["a", "b", "c"], "y")
    assert abs(w["a"] - 2.0) < 0.05 and abs(w["b"] + 1.0) < 0.05
    ranks = dict(MD.recursive_elimination(df, ["a", "b", "c"], "y"))
    assert ranks["a"] == 1 and ranks["c"] == 3


def test_stepwise_forward(spark):
    df, X, y = _data(spark)

    def score(cols):
        w = np.linalg.lstsq(X[:, [["a", "b", "c"].index(c) for c in cols]], y - y.mean(), rcond=None)[0]
        r = y - y.mean() - X[:, [["a", "b", "c"].index(c) for c in cols]] @ w
        return float(np.mean(r * r)) + 0.01 * len(cols)

    chosen, _ = MD.stepwise(df, ["a", "b", "c"], score, forward=True)
    assert set(chosen) == {"a", "b"}


def test_stepwise_takes_the_best_candidate():
    table = {"a": 5, "b": 3, "c": 1, "ab": 2.5, "abc": 2.4, "ac": 2, "bc": 4}
    score = lambda cols: table["".join(sorted(cols))]
    assert MD.stepwise(None, ["a", "b", "c"], score) == (["c"], 1)
    assert MD.stepwise(None, ["a", "b", "c"], score, forward=False) == (["c"], 1)


def test_recursive_elimination_fits_an_intercept(spark):
    rng = np.random.default_rng(4)
    X = rng.standard_normal((300, 3)) + np.array([0, 10, 0])
    y = X @ np.array([0.5, 0.01, 0.2]) + 100
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(X, y)], "a double, b double, c double, y double")
    assert dict(MD.recursive_elimination(df, ["a", "b", "c"], "y")) == {"a": 1, "c": 2, "b": 3}


def test_early_stop_and_refit(spark):
    losses = [5, 4, 3, 3.5, 3.4, 3.3, 1]
    scores = spark.createDataFrame([(f, k + 1, float(v)) for f in (0, 1) for k, v in enumerate(losses)], "fold int, round int, loss double")
    assert MD.early_stopped_round(scores, patience=3) == (3, 3.0) and MD.early_stopped_round(scores, patience=10) == (7, 1.0)
    df, _, _ = _data(spark, n=120)
    x = MD.assemble(df, ["a", "b", "c"]).withColumn("label", F.col("y")).withColumn("fold", F.col("id") % 3)
    model, rounds, _ = MD.fit_best_round(x, "fold", max_iter=4, patience=2, maxDepth=2, seed=1)
    assert model.getNumTrees == rounds <= 4


def test_lsi_spans_the_leading_singular_directions(spark):
    rng = np.random.default_rng(5)
    A = (rng.random((30, 12)) < 0.3) * rng.random((30, 12)) + np.outer(rng.random(30), rng.random(12)) * 3
    w = spark.createDataFrame([(i, f"t{j}", float(A[i, j])) for i in range(30) for j in range(12) if A[i, j]], "d int, t string, w double")
    v = {r.t: r.v for r in MD.lsi_vectors(w, "d", "t", "w", 2, rounds=40).collect()}
    V = np.array([v[f"t{j}"] for j in range(12)])
    U = np.linalg.svd(A)[2][:2].T
    assert np.allclose(V @ V.T, U @ U.T, atol=1e-3)


def test_logistic_beats_constant(spark):
    df, X, y = _data(spark)
    x = MD.assemble(df, ["a", "b", "c"]).withColumn("label", (F.col("y") > 0.5).cast("double"))
    m = MD.logistic(1.0, 400).fit(x)
    auc = BinaryClassificationEvaluator().evaluate(m.transform(x))
    assert auc > 0.9


def test_permutation_importance_orders_features(spark):
    df, X, y = _data(spark, n=300)
    imp = {r.feature: r.importance for r in MD.permutation_importance(df, ["a", "b", "c"], "y", "id", splits=2).collect()}
    assert imp["a"] > imp["b"] > imp["c"]


def test_model_queries_score_every_document(spark):
    from featlab.plans import models_q as Q
    SF = "/root/testdata/sf0.001"
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in Q._doc_features(spark, SF).collect()) == ids
    for query in (Q.m04_m06_logistic_cv, Q.m08_fm_classifier, Q.m03_m10_greedy_tune_refit):
        rows = query(spark, SF).collect()
        assert sorted(r.doc_id for r in rows) == ids
        assert all(v is not None and v == v for r in rows for v in r)


def test_word_vector_query_returns_whole_vectors(spark):
    from featlab.plans import models_q as Q
    SF = "/root/testdata/sf0.001"
    vecs = {r.doc_id: r.vec for r in Q.q04_q05_word_vectors(spark, SF).collect()}
    assert len(vecs) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {len(v) for v in vecs.values()} == {16} and (np.std(list(vecs.values()), axis=0) > 0).all()


def test_word_vectors_are_learned_by_several_tasks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, [f"{'ab'[k % 2]}{i}" for i in rng.integers(0, 8, 40)]) for k in range(60)]
    docs = spark.createDataFrame([*rows, (60, [])], "doc_id int, tok array<string>").repartition(4)
    assert MD.word_vectors(docs, "tok", size=8).getNumPartitions() == 1
    monkeypatch.setattr(MD, "FIT_TOKENS", 700)   # 2400 tokens
    m = MD.word_vectors(docs, "tok", size=8)
    assert m.getNumPartitions() == 4
    assert {r.word for r in m.getVectors().collect()} == {w for _, t in rows for w in t}
    assert m.transform(docs).count() == 61


def test_topic_keywords_in_blocks(spark, monkeypatch):
    """The closest words by dense linear algebra, with ids that repeat or are null, empty and null texts; a round
    sends the terms of the blocks, not every (document, term) row."""
    rng = np.random.default_rng(11)
    texts = [(k % 50 if k < 53 else None if k == 53 else k, [f"{'abc'[k % 3]}{i}" for i in rng.geometric(0.15, 30) % 17] + [f"w{i}" for i in rng.integers(0, 9, 4)]) for k in range(60)]
    texts += [(70, []), (71, None)]
    docs = spark.createDataFrame(texts, "doc_id int, tok array<string>").repartition(3)
    monkeypatch.setattr(MD, "BLOCK_ENTRIES", 150)
    got = {(r.doc_id, r.rank): (r.term, r.sim) for r in MD.topic_keywords(docs, "doc_id", "tok", k=3, top=4, rounds=30).collect()}
    by = {}
    for k, t in texts:
        for w in t or ():
            by.setdefault(k, []).append(w)
    words, ids = sorted({w for t in by.values() for w in t}), [k for k in by if k is not None]
    df = {w: sum(w in t for t in by.values()) for w in words}
    A = np.array([[by[k].count(w) * np.log(len(texts) / (1 + df[w])) for w in words] for k in ids])
    V = np.linalg.svd(A, full_matrices=False)[2][:3].T
    D = A @ V
    sim = D @ V.T / np.linalg.norm(D, axis=1)[:, None] / np.linalg.norm(V, axis=1)
    assert {k for k, _ in got} == set(ids) and all(w in by[k] for (k, _), (w, _) in got.items())
    for i, k in enumerate(ids):
        best = sorted((sim[i, words.index(w)] for w in set(by[k])), reverse=True)[:4]
        assert [r for d, r in sorted((d, r) for d, r in got if d == k)] == [1, 2, 3, 4]
        assert np.allclose([got[k, r][1] for r in range(1, 5)], best, atol=2e-3)


def _with_gaps(spark, n=200):
    """Rows whose features or label are NULL, NaN or infinite between good ones."""
    df, _, _ = _data(spark, n=n)
    at = F.col("id") % 10
    return df.withColumn("a", F.when(at == 1, None).when(at == 2, float("nan")).when(at == 3, float("inf")).otherwise(F.col("a"))) \
        .withColumn("y", F.when(at == 4, None).when(at == 5, float("nan")).otherwise(F.col("y"))).withColumn("fold", (F.col("id") % 3).cast("int"))


def test_missing_features_are_the_lowest_value_of_trees(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, float("-inf")), (4, -5.0), (5, float("inf"))], "id int, a double")
    got = {r.id: r.features[0] for r in MD.assemble_for_trees(df, ["a"]).collect()}
    assert got == {1: -1e300, 2: -1e300, 3: -1e300, 4: -5.0, 5: 1e300}


def test_boosting_rounds_with_missing_features_and_labels(spark):
    x = MD.assemble_for_trees(_with_gaps(spark), ["a", "b", "c"]).withColumn("label", F.col("y"))
    rows = MD.cv_rounds(x, "fold", "regression", max_iter=2, maxDepth=2, seed=1).collect()
    assert sorted((r.fold, r.round) for r in rows) == [(f, k) for f in range(3) for k in (1, 2)]
    assert all(np.isfinite(r.loss) for r in rows)


def _odd_documents(tmp_path):
    """Documents and labels, a tenth without text or length, one of length 0."""
    rng = np.random.default_rng(8)
    texts = ["\n".join(" ".join(f"w{x}" for x in rng.integers(0, 50, rng.integers(1, 9))) for _ in range(rng.integers(1, 6))) for _ in range(90)]
    texts = [None if k % 10 == 3 else t for k, t in enumerate(texts)]
    pd.DataFrame({"doc_id": range(90), "text": texts, "lang": "en", "source": "s",
                  "n_chars": pd.array([None if k % 10 == 4 else 0 if k == 7 else len(t or "") for k, t in enumerate(texts)], "Int64")}).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"doc_id": range(60), "quality": [k % 2 for k in range(60)], "toxic": [k % 3 % 2 for k in range(60)]}).to_parquet(tmp_path / "labels.parquet")
    return str(tmp_path)


def test_greedy_tuning_query_scores_documents_with_missing_features(spark, tmp_path):
    from featlab.plans import models_q as Q
    rows = Q.m03_m10_greedy_tune_refit(spark, _odd_documents(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(90)) and all(np.isfinite(r.prediction) for r in rows)


def test_forest_grid_query_with_missing_features(spark, tmp_path):
    from featlab.plans import filled as Q
    rows = Q.m07_forest_grid(spark, _odd_documents(tmp_path)).collect()
    assert len(rows) == 8 and all(np.isfinite(r.score) for r in rows) and sum(r.best for r in rows) == 2


def test_feature_rankings_query_with_missing_features(spark, tmp_path):
    from featlab.plans import filled as Q
    rows = Q.f03_f07_f08_feature_rankings(spark, _odd_documents(tmp_path)).collect()
    assert sorted(r.feature for r in rows) == ["digit_rate", "log_chars", "word_rate"]
    assert all(np.isfinite([r.score, r.importance, r.impurity]).all() for r in rows)


def test_topic_keywords_by_lda(spark, monkeypatch):
    """Variational Bayes of unit TF-IDF documents, by dense arrays; ids that repeat or are null, empty and null texts, several blocks and parts."""
    from featlab.operators import topics as TP
    rng = np.random.default_rng(12)
    texts = [(k % 50 if k < 53 else None if k == 53 else k, [f"{'abc'[k % 3]}{i}" for i in rng.geometric(0.15, 30) % 17] + [f"w{i}" for i in rng.integers(0, 9, 4)] + ["all"]) for k in range(60)]
    texts += [(70, []), (71, None)]
    docs = spark.createDataFrame(texts, "doc_id int, tok array<string>").repartition(3)
    monkeypatch.setattr(MD, "BLOCK_ENTRIES", 150)
    monkeypatch.setattr(TP, "PART_TERMS", 9)
    got = {(r.doc_id, r.rank): (r.term, r.sim) for r in MD.topic_keywords(docs, "doc_id", "tok", k=3, top=4, rounds=5, method="lda", seed=4).collect()}
    by = {}
    for k, t in texts:
        for w in t or ():
            by.setdefault(k, []).append(w)
    words, ids = sorted({w for t in by.values() for w in t}), [k for k in by if k is not None]
    df = np.array([sum(w in t for t in by.values()) for w in words])
    A = np.array([[by[k].count(w) for w in words] for k in ids]) * np.log(len(texts) / df)
    A /= np.linalg.norm(A, axis=1)[:, None]
    start = spark.createDataFrame([(w,) for w in words], "term string").selectExpr(*[f"pmod(xxhash64(4, {j}, term), 20001) / 10000 - 1" for j in range(3)]).collect()
    lam, total, gamma = 1 + 0.17 * np.array([list(map(float, r)) for r in start]), np.full(3, float(len(words))), np.repeat((1 + A.sum(axis=1))[:, None] / 3, 3, axis=1)

    def mixes(X, beta, gamma, steps):
        for _ in range(steps):
            theta = np.exp(TP.digamma(gamma) - TP.digamma(gamma.sum(axis=1))[:, None])
            gamma = 1 / 3 + theta * ((X / (theta @ beta.T + 1e-100)) @ beta)
        return gamma
    for _ in range(5):
        beta = np.exp(TP.digamma(lam) - TP.digamma(total))
        gamma = mixes(A, beta, gamma, TP.E_STEPS)
        theta = np.exp(TP.digamma(gamma) - TP.digamma(gamma.sum(axis=1))[:, None])
        lam = 1 / 3 + beta * ((A / (theta @ beta.T + 1e-100)).T @ theta)
        total = lam.sum(axis=0)
    beta = np.exp(TP.digamma(lam) - TP.digamma(total))
    one = np.diag((df < len(texts)).astype(float))
    D, V = mixes(A, beta, gamma, TP.LAST_STEPS), mixes(one, beta, np.repeat((1 + one.sum(axis=1))[:, None] / 3, 3, axis=1), TP.LAST_STEPS)
    sim = D @ V.T / np.linalg.norm(D, axis=1)[:, None] / np.linalg.norm(V, axis=1)
    assert {k for k, _ in got} == set(ids) and all(w in by[k] for (k, _), (w, _) in got.items())
    for i, k in enumerate(ids):
        best = sorted((sim[i, words.index(w)] for w in set(by[k])), reverse=True)[:4]
        assert np.allclose([got[k, r][1] for r in range(1, 5)], best, atol=1e-4)


def test_topic_keyword_query_is_lda(spark, monkeypatch):
    from featlab.plans import models_q as Q
    used = []
    monkeypatch.setattr(MD, "topic_keywords", lambda *a, **kw: used.append(kw.get("method")))
    Q.x17_topic_keywords(spark, "/root/testdata/sf0.001")
    assert used == ["lda"]


def test_topic_keywords_of_no_documents(spark):
    docs = spark.createDataFrame([(1, [])], "doc_id int, tok array<string>")
    for method in ("lsi", "lda"):
        assert MD.topic_keywords(docs, "doc_id", "tok", method=method, rounds=2).collect() == []
        assert MD.topic_keywords(docs.limit(0), "doc_id", "tok", method=method, rounds=2).columns == ["doc_id", "rank", "term", "sim"]


def test_digamma():
    from featlab.operators.topics import digamma
    assert np.allclose(digamma(np.array([1.0, 0.5, 0.25, 10.0])), [-0.5772156649, -1.9635100260, -4.2274535334, 2.2517525891], atol=1e-8)
