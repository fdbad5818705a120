"""Hot values, empty and NULL inputs, and settings beyond one chunk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featlab.functions.arrays import invert_permutation
from featlab.operators import encoders, plotdata, sequential, stats, vectors
from featlab.operators.mean_encoding import MeanEncoder


def test_quantiles_of_a_hot_value(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random(4000) < 0.9, 0.0, rng.standard_normal(4000))
    df = spark.createDataFrame([(int(k % 3), float(v)) for k, v in enumerate(x)] + [(0, None)], "g int, x double").repartition(5)
    probs = [0.0, 0.03, 0.25, 0.5, 0.931, 1.0]
    got = {r.prob: r.value for r in stats.exact_quantiles(df, "x", probs).collect()}
    assert all(got[p] == pytest.approx(np.quantile(x, p)) for p in probs)
    got = {(r.g, r.prob): r.value for r in stats.exact_quantiles(df, "x", probs, ["g"]).collect()}
    assert all(got[g, p] == pytest.approx(np.quantile(x[g::3], p)) for g in range(3) for p in probs)
    assert stats.exact_quantiles(df.filter("x > 99"), "x", probs).count() == 0


@pytest.mark.parametrize("beta", [0.0, 0.5, 0.9, 0.999, 1.0])
def test_moving_average_at_any_beta(spark, beta):
    x = np.random.default_rng(2).standard_normal(2500)
    df = spark.createDataFrame([(k, float(v)) for k, v in enumerate(x)], "id long, x double")
    got = [r.ema for r in sequential.ema(df, [], [F.col("id")], "x", beta=beta).orderBy("id").collect()]
    e, want = 0.0, []
    for v in x:
        e = beta * e + (1 - beta) * v
        want.append(e)
    assert np.allclose(got, want, atol=1e-9)


def test_window_wider_than_a_chunk(spark):
    df = spark.createDataFrame([(k, float(k)) for k in range(30)], "id long, x double")
    got = {r.id: r.m for r in sequential.sliding(df, [], [F.col("id")], 12, 0, {"m": F.min("x")}, chunk_rows=5).collect()}
    assert got == {k: float(max(0, k - 12)) for k in range(30)}


def test_feature_dictionary_gives_null_its_own_index(spark):
    df = spark.createDataFrame([("x", 1.0), (None, 2.0), ("y", 3.0)], "c string, n double")
    d = encoders.fit_feature_dictionary(df, numeric=["n"])
    xi = {r.n: r.xi for r in d.parse(df, keep=["n"]).collect()}
    assert all(v is not None for row in xi.values() for v in row) and len({row[0] for row in xi.values()}) == 3 and d.dim == 4


def test_broadcasts_share_one_budget():
    sizes = {"a": 10, "b": 30, "c": 100}
    assert encoders._broadcast_some(sizes, 45) == {"a", "b"} and encoders._broadcast_some(sizes, 5) == set()


@pytest.mark.parametrize("block_bytes", [8, 64, 1 << 20])
def test_similarity_with_small_blocks_and_null_vectors(spark, block_bytes):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((12, 4))
    rows = [(k, [float(x) for x in r]) for k, r in enumerate(v)] + [(50, None), (51, [])]
    got = {}
    for r in vectors.topk_similar(spark.createDataFrame(rows, "id long, vec array<double>"), "id", "vec", k=3, block_bytes=block_bytes).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.other_id
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = n @ n.T
    np.fill_diagonal(s, -2)
    assert {k: [r[1], r[2], r[3]] for k, r in got.items()} == {k: np.argsort(-s[k])[:3].tolist() for k in range(12)}


def test_mean_encoding_in_long_form_equals_the_wide_one(spark):
    rng = np.random.default_rng(4)
    rows = [(k, str(rng.choice(["a", "b", "c"])) if k % 17 else None, str(rng.choice(["u", "v", "w"])) if k % 23 else None, int(k % 4)) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, cat string, y string, f int")
    enc = MeanEncoder(["cat"], "y", "id", n_splits=4, target_type="classification", fold_col="f")
    wide, _ = enc.fit_transform(df)
    want = {(r.id, c): r[f"cat_pred_{c}"] for r in wide.collect() for c in "uvw"}
    got = {(r["id"], r["class"]): r.value for r in enc.classification_long(df, "cat").collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_plot_data_of_empty_and_constant_columns(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    flat = spark.createDataFrame([(2.0,)] * 5, "x double")
    assert plotdata.histogram(empty, "x").count() == 0 and plotdata.kde(empty, "x").count() == 0
    assert plotdata.histogram(flat, "x").first()["count"] == 5 and plotdata.kde(flat, "x", points=5).count() == 5


def test_inverse_permutation(spark):
    df = spark.createDataFrame([([2, 0, 1],), ([],)], "p array<int>")
    assert [r[0] for r in df.select(invert_permutation("p")).collect()] == [[1, 2, 0], []]
