"""Row-local windows, counter-based draws, epoch permutations, regularisation paths, facet fits, early stops."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featlab.functions import draws as D
from featlab.operators import epochs as EP
from featlab.operators import fits as FT
from featlab.operators import linear_paths as LP
from featlab.operators import plotdata as G
from featlab.operators import sequential as S
from featlab.operators import token_windows as TW

DOCS = [(1, list("abcdefghij")), (2, ["x"]), (3, []), (4, None), (5, ["p", None, "q"]), (None, ["n", "m"])]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, tok array<string>").repartition(3)


@pytest.mark.parametrize("chunk", [1, 3, 2000])
def test_windows_and_pairs_over_chunks(spark, chunk):
    got = {(r.doc_id, r.pos): tuple(r)[1:] for r in TW.windows(docs(spark), ["doc_id"], "tok", 2, chunk=chunk).collect()}
    want, pairs = {}, set()
    for k, t in DOCS:
        for i, x in enumerate(t or []):
            near = {o: t[i + o] for o in (-2, -1, 1, 2) if 0 <= i + o < len(t)}
            want[k, i + 1] = (i + 1, x, near.get(-1), near.get(1), near.get(-2), near.get(2))
            pairs |= {(k, i + 1, o, x, y) for o, y in near.items()}
    assert {k: (v[0], v[1], v[2], v[3], v[4], v[5]) for k, v in got.items()} == want
    rows = [tuple(r) for r in TW.skipgrams(docs(spark), ["doc_id"], "tok", 2, chunk=chunk).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == pairs
    drawn = [tuple(r) for r in TW.skipgrams(docs(spark), ["doc_id"], "tok", 2, num_skips=2, seed=9, chunk=chunk).collect()]
    expect = set()
    for k, t in DOCS:
        for i in range(len(t or [])):
            here = sorted((hashlib.md5(f"9:{'' if k is None else k}:{i + 1}:{o}".encode()).hexdigest(), o) for o in (-2, -1, 1, 2) if 0 <= i + o < len(t))
            expect |= {(k, i + 1, o, t[i], t[i + o]) for _, o in here[:2]}
    assert len(drawn) == len(set(drawn)) and set(drawn) == expect


def test_draws_do_not_depend_on_partitions_and_have_their_moments(spark):
    def values(parts):
        df = spark.range(20_000).repartition(parts)
        return {r.id: tuple(r)[1:] for r in df.select("id", D.uniform(3, "id"), D.normal(3, "id", 5, 1.0, 2.0), D.truncated_normal(3, "id", 1.0, 2.0),
                                                        D.gamma(3, "id", 2.5, 1.5), D.gamma(3, "id", 0.4, 2.0)).collect()}
    one, many = values(1), values(9)
    assert one == many
    u, n, t, g, small = (np.array(x) for x in zip(*one.values()))
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - .5) < .01 and abs(u.var() - 1 / 12) < .002
    assert abs(n.mean() - 1) < .05 and abs(n.std() - 2) < .05
    assert np.abs(t - 1).max() <= 4 and abs(t.std() - 2 * .8796) < .03
    assert g.min() > 0 and abs(g.mean() - 3.75) < .06 and abs(g.var() - 2.5 * 2.25) < .25
    assert small.min() >= 0 and abs(small.mean() - .8) < .03 and abs(small.var() - 1.6) < .12
    other = np.array([r[0] for r in spark.range(20_000).select(D.uniform(4, "id")).collect()])
    assert abs(np.corrcoef(u[np.argsort(list(one))], other)[0, 1]) < .03


def test_epochs_are_permutations(spark):
    for n in (1, 2, 3, 5, 16, 17, 997):
        places = spark.range(n).crossJoin(spark.range(3).toDF("e")).select("e", EP.permuted(F.col("id"), n, F.col("e") * 71 + 5).alias("p")).groupBy("e").agg(
            F.sort_array(F.collect_list("p")).alias("p")).collect()
        assert [r.p for r in places] == [list(range(n))] * 3
    rows = spark.range(1000).select("id", EP.permuted(F.col("id"), 1000, F.lit(11)).alias("a"), EP.permuted(F.col("id"), 1000, F.lit(12)).alias("b")).toPandas()
    for x, y in (("id", "a"), ("id", "b"), ("a", "b")):
        assert abs(np.corrcoef(rows[x], rows[y])[0, 1]) < .1
    assert np.mean(np.abs(np.diff(rows["a"].to_numpy())) == 1) < .02  # neighbours do not stay together


def test_epoch_batches_and_padding(spark):
    df = spark.createDataFrame([(k, list(range(k % 7)) if k % 5 else None, "same") for k in range(50)], "id long, seq array<int>, batch2 string").repartition(4)
    got = EP.padded_batches(EP.epoch_batches(df, ["id"], 8, epochs=2, seed=3), ["seq"], -1).collect()
    assert len(got) == 100
    for e in (0, 1):
        ids = [r.id for r in got if r.epoch == e]
        assert sorted(ids) == list(range(50))
        for b in range(7):
            batch = [r for r in got if (r.epoch, r.batch) == (e, b)]
            assert sorted(r.place for r in batch) == list(range(8 if b < 6 else 2))
            longest = max(r.seq_length for r in batch)
            for r in batch:
                real = list(range(r.id % 7)) if r.id % 5 else []
                assert r.seq_length == len(real) and r.seq == real + [-1] * (longest - len(real))
    orders = [[r.id for r in sorted((r for r in got if r.epoch == e), key=lambda r: (r.batch, r.place))] for e in (0, 1)]
    assert orders[0] != orders[1]
    again = EP.epoch_batches(df.repartition(1), ["id"], 8, epochs=2, seed=3).collect()
    assert {(r.id, r.epoch): (r.batch, r.place) for r in again} == {(r.id, r.epoch): (r.batch, r.place) for r in got}
    assert EP.epoch_batches(df, ["id"], 8, epochs=2, drop_remainder=True).count() == 96
    assert EP.epoch_batches(df.limit(0), ["id"], 8, epochs=2).count() == 0


def plain_fit(x, y, alpha, ratio, intercept):
    """Proximal gradient steps on the rows."""
    mx, my = (x.mean(0), y.mean()) if intercept else (np.zeros(x.shape[1]), 0.0)
    a, b, n = x - mx, y - my, len(y)
    step = 1 / (np.linalg.eigvalsh(a.T @ a / n)[-1] + alpha * (1 - ratio))
    w = np.zeros(x.shape[1])
    for _ in range(4000):
        w = w - step * (a.T @ (a @ w - b) / n + alpha * (1 - ratio) * w)
        w = np.sign(w) * np.maximum(np.abs(w) - step * alpha * ratio, 0)
    return w, my - mx @ w


def test_paths_choose_what_plain_fits_choose(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 4)) * [1, 2, .5, 1]
    y = x @ [2.0, 0, -1.0, 0] + 3 + rng.normal(size=120)
    fold = np.arange(120) % 3
    rows = [(*map(float, r), float(v), int(f)) for r, v, f in zip(x, y, fold)] + [(None, 1.0, 1.0, 1.0, 1.0, 0), (1.0, 1.0, 1.0, 1.0, float("nan"), 1), (1.0, 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double, fold int").repartition(3)
    alphas, ratios = (1.0, .3, .1, .03, .001), (1.0, .5, 0.0)
    best, log = LP.cross_validate(df, list("abcd"), "y", "fold", alphas, ratios, (True, False))
    errors = {}
    for ratio in ratios:
        for intercept in (True, False):
            for alpha in alphas:
                e = []
                for f in range(3):
                    w, b = plain_fit(x[fold != f], y[fold != f], alpha, ratio, intercept)
                    e.append(np.mean((y[fold == f] - x[fold == f] @ w - b) ** 2))
                errors[alpha, ratio, intercept] = np.mean(e)
    for a, ratio, intercept, e in log:
        assert e == pytest.approx(errors[a, ratio, intercept], rel=1e-6)
    want = min(errors, key=errors.get)
    assert (best["alpha"], best["l1_ratio"], best["intercept"]) == want
    w, b = plain_fit(x, y, *want)
    assert np.allclose(best["fit"].weights, w, atol=1e-6) and best["fit"].intercept == pytest.approx(b, abs=1e-6)
    auto, path = LP.cross_validate(df, list("abcd"), "y", "fold", n_alphas=20)
    assert len(path) == 20 and LP.descend(sum(LP.fold_moments(df, list("abcd"), "y", "fold").values()), path[0][0] * 1.001, 1.0).weights.tolist() == [0] * 4
    with pytest.raises(ValueError):
        LP.cross_validate(df.limit(0), ["a"], "y", "fold", alphas)


def huber(x, y, order):
    z, t = (x - x.mean()) / x.std(), (y - y.mean()) / y.std()
    m = np.stack([z ** k for k in range(order + 1)], 1)
    c, rounds = np.linalg.lstsq(m, t, rcond=None)[0], 1
    while rounds < 50:
        r = np.abs(t - m @ c)
        s = np.sort(r)[(len(r) - 1) // 2] / FT.MAD
        w = np.where(r <= FT.HUBER * s, 1, FT.HUBER * s / np.maximum(r, 1e-300))
        new = np.linalg.lstsq(m * np.sqrt(w)[:, None], t * np.sqrt(w), rcond=None)[0]
        rounds += 1
        moved, c = np.abs(new - c).max(), new
        if moved < 1e-8:
            break
    grid = np.linspace(x.min(), x.max(), 20)
    return grid, (np.stack([((grid - x.mean()) / x.std()) ** k for k in range(order + 1)], 1) @ c) * y.std() + y.mean(), rounds


@pytest.mark.parametrize("order", [1, 2])
def test_robust_fits_ignore_planted_outliers(spark, order):
    rng = np.random.default_rng(4)
    rows, data = [], {}
    for f, slope in (("a", 2.0), ("b", -1.0), (None, .5)):
        x = rng.random(150) * 10
        y = slope * x + (x * x * .3 if order == 2 else 0) + 1 + rng.normal(0, .1, 150)
        y[:25] += 60
        data[f] = x, y
        rows += [(f, 1, float(a), float(b)) for a, b in zip(x, y)]
    rows += [("a", 1, None, 1.0), ("b", 1, 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "facet string, n int, x double, y double").repartition(4)
    got = {r.facet: r for r in FT.fitted_polynomials(df, "y", "x", ["facet"], order, robust=True).collect()}
    plain = {r.facet: r for r in FT.fitted_polynomials(df, "y", "x", ["facet"], order).collect()}
    for f, (x, y) in data.items():
        grid, want, rounds = huber(x, y, order)
        assert np.allclose(np.polynomial.polynomial.polyval(grid, got[f].coefficients), want, atol=1e-5) and got[f].n == 150 and abs(got[f].rounds - rounds) <= 1
        assert np.allclose(plain[f].coefficients, np.polynomial.polynomial.polyfit(x, y, order), atol=1e-6)
        true = np.polynomial.polynomial.polyval(grid, [1, {"a": 2.0, "b": -1.0, None: .5}[f], .3][:order + 1])
        assert np.abs(np.polynomial.polynomial.polyval(grid, got[f].coefficients) - true).max() < np.abs(np.polynomial.polynomial.polyval(grid, plain[f].coefficients) - true).max() / 3
    whole = FT.fitted_polynomials(df.filter("facet = 'a'"), "y", "x", order=1).first()
    assert len(whole.coefficients) == 2
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "x double, y double")
    assert FT.fitted_polynomials(flat, "y", "x").first().coefficients == pytest.approx([3.0, 0.0])
    assert FT.fitted_polynomials(flat.limit(0), "y", "x", robust=True).count() == 0


def test_no_gain_rule(spark):
    log = spark.createDataFrame([("flat", r, 1.0 if r == 2 else 2.0 + (r % 2) * .1) for r in range(1, 14)] + [("falls", r, 9.0 - r) for r in range(1, 9)], "run string, round int, loss double")
    got = {r.run: (r.best_round, r.stop_round) for r in S.early_stop(log, ["run"], "round", "loss", no_gain=5).collect()}
    assert got == {"flat": (2, 8), "falls": (8, None)}
    up = {r.run: r.stop_round for r in S.early_stop(log, ["run"], "round", "loss", patience=None, no_gain=3, lower_is_better=False).collect()}
    assert up == {"flat": 5, "falls": 5}


def test_joint_bins_and_densities_of_few_rows(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0), (1.0, None), (None, 5.0), (0.4, 2.0)], "x double, y double")
    bins = G.joint_bins(df, "x", "y", 2)
    assert sorted(tuple(r) for r in bins.collect()) == [(0, 0, 1), (0, 1, 1), (1, 1, 1)]
    assert sorted(tuple(r) for r in G.joint_marginals(bins).collect()) == [("x", 0, 2), ("x", 1, 1), ("y", 0, 1), ("y", 1, 2)]
    assert G.joint_bins(df.limit(0), "x", "y").count() == 0
    values = [0.0, 1.0, 1.0, .4]
    got = G.kde(df, "x", points=5, bandwidth=.5).orderBy("gi").collect()
    for r in got:
        want = np.mean([math.exp(-((v - r.x) / .5) ** 2 / 2) / (.5 * math.sqrt(2 * math.pi)) for v in values])
        assert r.density == pytest.approx(want)
