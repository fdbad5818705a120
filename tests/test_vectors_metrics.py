"""Exact top-k similarity, metrics and matrices against numpy."""

import numpy as np
import pandas as pd

from featlab.operators import linalg as L
from featlab.operators import metrics as M
from featlab.operators import stats as ST
from featlab.operators.vectors import topk_similar


def test_topk_matches_numpy_bruteforce(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(150, 8))
    X[10] = X[11]                              # a duplicate pair (ties)
    pdf = pd.DataFrame({"id": np.arange(150), "v": list(X)})
    got = topk_similar(spark.createDataFrame(pdf), "id", "v", k=5, block_bytes=2048).toPandas()
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    S = U @ U.T
    np.fill_diagonal(S, -np.inf)
    for q in range(150):
        order = np.lexsort((np.arange(150), -S[q]))[:5]
        g = got[got.query_id == q].sort_values("rank")
        assert g.other_id.tolist() == order.tolist()
        np.testing.assert_allclose(g.sim.to_numpy(), S[q, order], atol=1e-12)


def test_auc_and_threshold(spark):
    pdf = pd.DataFrame({"y": [0, 0, 1, 1, 0, 1], "p": [0.1, 0.4, 0.35, 0.8, 0.8, 0.9]})
    df = spark.createDataFrame(pdf)
    auc = M.auc(df, "y", "p").first().auc
    pos, neg = pdf.p[pdf.y == 1].to_numpy(), pdf.p[pdf.y == 0].to_numpy()
    exp = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert abs(auc - exp) < 1e-12
    t = M.best_threshold(df, "y", "p").first()
    assert t.threshold == 0.1 and abs(t.f1 - 0.75) < 1e-12


def test_macro_f1_hits_only(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "label int, pred int")
    f = M.macro_f1(df, "label", "pred").first().macro_f1
    # class 0: p=1/2 r=1/2 f=0.5; class 1: p=1/2 r=1 f=2/3; class 2 has no hit
    assert abs(f - (0.5 + 2 / 3) / 2) < 1e-12


def test_segment_sum_fixture(spark):
    df = spark.createDataFrame(list(zip([0, 0, 0, 1, 2, 2, 3, 3], [5, 1, 7, 2, 3, 4, 1, 3])), "seg int, v int")
    got = {r.seg: r["sum"] for r in ST.segment_reduce(df, "seg", "v").collect()}
    assert got == {0: 13, 1: 2, 2: 7, 3: 4}


def test_exact_quantiles_match_numpy(spark):
    x = np.random.default_rng(1).normal(size=501)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    q = {r.prob: r.value for r in ST.exact_quantiles(df, "x", [0.1, 0.5, 0.9]).collect()}
    for p in (0.1, 0.5, 0.9):
        assert abs(q[p] - np.quantile(x, p)) < 1e-12


def test_eye_and_matmul(spark):
    e = L.eye(spark, 3)
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (2, 2, 4.0)], "i long, j long, v double")
    got = {(r.i, r.j): r.v for r in L.matmul(a, e).collect()}
    assert got == {(0, 0): 1.0, (0, 1): 2.0, (1, 0): 3.0, (2, 2): 4.0}
    t = L.trace_and_norm(a).first()
    assert t.trace == 5.0


def test_gamma_and_truncated_normal_columns(spark):
    from featlab.functions.scalar import with_random_columns
    df = spark.range(0, 20000, 1, 4)
    out = with_random_columns(df, 3, gamma={"g": (2.0, 1.5)}, truncated_normal={"t": (1.0, 2.0)}).toPandas()
    assert len(out) == 20000 and out["t"].between(-3.0, 5.0).all()
    assert abs(out["g"].mean() - 3.0) < 0.1 and (out["g"] > 0).all()
    again = with_random_columns(df, 3, gamma={"g": (2.0, 1.5)}).toPandas()
    assert np.allclose(np.sort(again["g"].to_numpy()), np.sort(out["g"].to_numpy()))
