"""Histogram boosting against a plain loop over all thresholds, and its knobs."""

import math
from dataclasses import replace

import numpy as np
import pytest

from featlab.operators import boosting as B

FEATURES = ["a", "b", "c"]


def make(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n) / 4, rng.integers(0, 30, n) - 10.0, rng.integers(0, 3, n) * 1.0], 1)
    x[rng.random(x.shape) < .05] = np.nan
    z = np.nan_to_num(x)
    y = z[:, 0] * 2 - (z[:, 1] > 3) * 3 + z[:, 2] * z[:, 0] + rng.normal(0, .3, n)
    return x, y


def frame(spark, x, y, parts=3):
    n = len(y)
    rows = [(k, *[None if math.isnan(v) and k % 2 else float(v) for v in x[k]], float(y[k]), k % 3, "extra") for k in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, fold int, _y string").repartition(parts)


def plain(x, y, p, rounds, rows=None):
    """Boosting by loops over every value of every feature; scores of all rows after ``rounds``, and losses."""
    rows = np.arange(len(y)) if rows is None else rows
    z = np.where(np.isnan(x), -np.inf, x)
    k = p.classes
    if p.objective == "softmax":
        raw = np.tile(np.log([np.mean(y[rows] == c) for c in range(k)]), (len(y), 1))
    elif p.objective == "binary":
        m = y[rows].mean()
        raw = np.full((len(y), 1), math.log(m / (1 - m)))
    else:
        raw = np.full((len(y), 1), np.mean(y[rows]) if p.objective == "l2" else B_median(y[rows]))

    def score(g, h):
        t = max(abs(g) - p.lambda_l1, 0)
        return t * t / (h + p.lambda_l2) if h + p.lambda_l2 > 0 else 0

    def grow(members, g, h, depth, out):
        G, H = g[members].sum(), h[members].sum()
        best = None
        if depth < p.max_depth:
            for f in range(x.shape[1]):
                for v in np.unique(z[members, f]):
                    left = members[z[members, f] <= v]
                    gl, hl, nl = g[left].sum(), h[left].sum(), len(left)
                    if min(nl, len(members) - nl) < max(1, p.min_data_in_leaf) or min(hl, H - hl) < p.min_child_weight:
                        continue
                    gain = score(gl, hl) + score(G - gl, H - hl) - score(G, H)
                    if gain > p.min_split_gain and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, v
        if best is None:
            return lambda q: np.full(len(q), -p.learning_rate * math.copysign(max(abs(G) - p.lambda_l1, 0), G) / (H + p.lambda_l2)), [members]
        _, f, v = best
        (lf, ll), (rf, rl) = (grow(members[side], g, h, depth + 1, out) for side in (z[members, f] <= v, z[members, f] > v))
        return (lambda q: np.where(q[:, f] <= v, lf(q), rf(q))), ll + rl

    log = [B.losses(p, raw, y)]
    for _ in range(rounds):
        g, h = B.gradients(p, raw, y)
        raw = raw + np.stack([grow(rows, g[:, c], h[:, c], 0, None)[0](z) for c in range(k)], 1)
        log.append(B.losses(p, raw, y))
    return B.link(p, raw), log


def B_median(v):
    return float(np.sort(v)[(len(v) - 1) // 2])


def scores(spark, df, model, bins):
    got = {r.id: list(r.score) for r in B.predict(df, model, bins, ["id"]).collect()}
    return np.array([got[k] for k in sorted(got)])


@pytest.mark.parametrize("p", [
    B.BoostParams(max_depth=1, lambda_l2=1.5, learning_rate=1.0),
    B.BoostParams(max_depth=3, lambda_l1=2.0, lambda_l2=.5, min_child_weight=9, learning_rate=.3),
    B.BoostParams(max_depth=4, min_data_in_leaf=15, min_split_gain=4.0, learning_rate=.5),
    B.BoostParams(objective="binary", max_depth=2, min_child_weight=2.0, learning_rate=.4),
    B.BoostParams(objective="softmax", classes=3, max_depth=2, lambda_l2=.1, learning_rate=.4)])
def test_equals_the_plain_loop(spark, p):
    x, y = make()
    if p.objective != "l2":
        y = np.digitize(y, [0.5, 4]).astype(float) if p.objective == "softmax" else (y > 1).astype(float)
    df = frame(spark, x, y)
    model, bins = B.fit(df, FEATURES, "y", ["id"], p, 4)
    want, _ = plain(x, y, p, 4)
    assert np.allclose(scores(spark, df, model, bins), want, atol=1e-9)


def test_l1_leaves_are_median_residuals(spark):
    x, y = make(200)
    p = B.BoostParams(objective="l1", max_depth=2, learning_rate=.5, min_data_in_leaf=5)
    df = frame(spark, x, y)
    model, bins = B.fit(df, FEATURES, "y", ["id"], p, 1)
    assert model.base == [B_median(y)]
    tree = model.rounds[0][0]
    got = {r.id: r._bins for r in B.binned(df, bins, ["id"]).collect()}
    leaf = tree.leaf_of(np.array([got[k] for k in range(len(y))]))
    for n in set(leaf.tolist()):
        assert tree.value[n] == pytest.approx(.5 * B_median(y[leaf == n] - model.base[0]))


def test_folds_losses_and_stopping(spark):
    x, y = make(300)
    p = B.BoostParams(max_depth=2, learning_rate=.6)
    df = frame(spark, x, y)
    bins = B.fit_bins(df, FEATURES)
    models = [B.Model(p, f) for f in range(3)]
    log = B.train(B.binned(df, bins, ["id"], "y", "fold"), bins, models, 12)  # beyond KEEP_EVERY
    fold = np.arange(len(y)) % 3
    for f in range(3):
        _, want = plain(x, y, p, 12, np.flatnonzero(fold != f))
        got = [(a, b) for k, _, a, b in log if k == f]
        assert np.allclose(got, [(w[fold != f].mean(), w[fold == f].mean()) for w in want], atol=1e-9)
    noise = np.random.default_rng(1).normal(size=len(y))
    stopped = [B.Model(p, f) for f in range(3)]
    noisy = frame(spark, x, noise)
    log = B.train(B.binned(noisy, bins, ["id"], "y", "fold"), bins, stopped, 12, patience=2, groups=[0, 0, 0])
    means = [np.mean([b for _, q, _, b in log if q == r]) for r in range(max(q for _, q, _, _ in log) + 1)]
    assert len(means) - 1 == int(np.argmin(means)) + 2 and all(len(m.rounds) == len(means) - 1 for m in stopped)


def test_grid_points_are_as_if_fitted_alone_and_tuning_takes_the_best(spark):
    x, y = make(240)
    df = frame(spark, x, y)
    base = B.BoostParams(max_depth=2, learning_rate=.5)
    grid = [base, replace(base, lambda_l2=50.0), replace(base, max_depth=1), replace(base, bagging_fraction=.5, feature_fraction=.4)]
    found = B.cross_validate(df, FEATURES, "y", ["id"], "fold", grid, 4)
    fold = np.arange(len(y)) % 3
    for g in range(3):
        logs = [plain(x, y, grid[g], 4, np.flatnonzero(fold != f))[1] for f in range(3)]
        means = [np.mean([logs[f][r][fold == f].mean() for f in range(3)]) for r in range(1, 5)]
        assert found[g] == (1 + int(np.argmin(means)), pytest.approx(min(means)))
    groups = (("depth", {"max_depth": (1, 2)}), ("lambdas", {"lambda_l1": (0.0, 3.0), "lambda_l2": (0.0, 50.0)}))
    best, rounds, log = B.tune(df, FEATURES, "y", ["id"], "fold", base, 4, groups=groups)
    rows = log.collect()
    assert len(rows) == 6 and sum(r.chosen for r in rows) >= 1
    last = [r for r in rows if r.chosen][-1]
    assert last.loss == min(r.loss for r in rows) and last.rounds == rounds
    assert all(getattr(best, a) == v for a, v in last.params.items())


def test_draws_do_not_depend_on_partitions(spark):
    x, y = make(300)
    p = B.BoostParams(bagging_fraction=.6, feature_fraction=.67, max_depth=3)
    one, bins = B.fit(frame(spark, x, y, 1), FEATURES, "y", ["id"], p, 3)
    many, _ = B.fit(frame(spark, x, y, 7), FEATURES, "y", ["id"], p, 3)
    for a, b in zip(one.rounds, many.rounds):
        assert a[0].feature == b[0].feature and a[0].bin == b[0].bin and np.allclose(a[0].value, b[0].value)
    assert any(set(t[0].feature) - {-1} != set(range(3)) for t in one.rounds)
    ids = np.arange(20_000)
    assert abs(B.in_bag(p, ids, 1).mean() - .6) < .02 and (B.in_bag(p, ids, 1) != B.in_bag(p, ids, 2)).any()


def test_sparse_histograms_bins_and_empty_tables(spark, monkeypatch):
    x, y = make(300)
    df = frame(spark, x, y)
    coarse = B.fit_bins(df, FEATURES, max_bin=4)
    assert [len(e) for e in coarse.edges] == [3, 3, 3] and list(coarse.edges[2]) == [0.0, 1.0, 2.0]
    p = B.BoostParams(max_depth=3)
    model, bins = B.fit(df, FEATURES, "y", ["id"], p, 2)
    monkeypatch.setattr(B, "CELLS", 0)
    # tasks import the module themselves, so the pass is run here on one batch
    import pyarrow as pa
    rows = B.binned(df, bins, ["id"], "y").collect()
    batch = pa.RecordBatch.from_pydict({"_rid": [r._rid for r in rows], "_y": [r._y for r in rows], "_fold": pa.array([0] * len(rows), pa.int32()),
                                        "_bins": pa.array([r._bins for r in rows], pa.list_(pa.int32())), "_raw": pa.array([[]] * len(rows), pa.list_(pa.float64()))})
    grow = B.Growing(0, 0, B.Tree(), [0], [0, 1, 2])
    m = B.Model(p, base=[0.0])
    def cells(found):
        return sorted((tuple(r.values()) for b in found for r in b.to_pylist()), key=lambda r: r[:5])
    sparse = cells(B._sums([m], [grow], bins.width, 0, False)([batch]))
    monkeypatch.setattr(B, "CELLS", 1 << 20)
    dense = cells(B._sums([m], [grow], bins.width, 0, False)([batch]))
    assert np.allclose(np.array(sparse), np.array(dense))
    empty = df.limit(0)
    none, bins = B.fit(empty, FEATURES, "y", ["id"], p, 2)
    assert none.base == [0.0] and B.predict(df, none, bins, ["id"]).count() == 300


def test_model_table_and_going_on(spark):
    x, y = make(300)
    df = frame(spark, x, y)
    p = B.BoostParams(max_depth=2, learning_rate=.3)
    bins = B.fit_bins(df, FEATURES)
    model = B.Model(p, 0)
    log = B.train(B.binned(df, bins, ["id"], "y", "fold"), bins, [model], 6)
    r, target = min(((r, a) for _, r, a, _ in log[1:]), key=lambda t: t[1])
    went = B.continue_until(df, model, bins, "y", ["id"], target, most=40)
    assert went[0][0] == 6 and went[-1][1] < target + 0.001 and all(a >= target + 0.001 for _, a in went[:-1])
    assert len(model.rounds) == went[-1][0]
    few = model.first(2)
    assert len(B.continue_until(df, few, bins, "y", ["id"], -1.0, most=3)) == 4 and len(few.rounds) == 5
    table = B.trees_table(spark, model, bins).collect()
    assert len(table) == sum(len(t.feature) for ts in model.rounds for t in ts)
    # the table scores a row as the model does
    row = {f: (0.0 if math.isnan(v) else float(v)) for f, v in zip(FEATURES, x[0])}
    nodes = {(t.round, t.node): t for t in table}
    total = model.base[0]
    for k in range(1, len(model.rounds) + 1):
        t = nodes[k, 0]
        while t.feature is not None:
            t = nodes[k, t.left if row[t.feature] <= t.threshold else t.right]
        total += t.value
    one = spark.createDataFrame([(0, *row.values())], "id long, a double, b double, c double")
    assert scores(spark, one, model, bins)[0][0] == pytest.approx(total)


def test_models_grown_on_cells_equal_those_grown_level_by_level(spark, monkeypatch):
    rng = np.random.default_rng(21)
    n = 700
    rows = [(int(i), float(rng.integers(0, 12)), None if i % 9 == 0 else float(rng.integers(0, 6)), float(rng.integers(0, 5)), float("nan") if i % 50 == 0 else float(rng.normal() * 3 + i % 7), int(i % 3)) for i in range(n)]
    df = spark.createDataFrame([*rows, *rows[:40]], "id long, a double, b double, c double, y double, fold int").repartition(3)
    bins = B.fit_bins(df, ["a", "b", "c"], 8)
    ready = B.binned(df, bins, ["id"], "y", "fold")
    params = [B.BoostParams(learning_rate=0.3, max_depth=9, min_data_in_leaf=4), B.BoostParams(learning_rate=0.3, max_depth=4, bagging_fraction=0.6, feature_fraction=0.7, min_child_weight=5),
              B.BoostParams(learning_rate=0.3, max_depth=3, bagging_fraction=0.9, lambda_l1=2.0, lambda_l2=1.0, min_split_gain=0.5)]
    passes = []
    plain = B.best_splits
    monkeypatch.setattr(B, "best_splits", lambda *a: passes.append(1) or plain(*a))

    def both(size):
        monkeypatch.setattr(B, "CELL_BYTES", size)
        models = [B.Model(p, f) for p in params for f in (0, 1, None)]
        log = B.train(ready, bins, models, 2)
        more = B.train(ready, bins, models, 1)
        x = np.array([[i, j, k] for i in range(bins.width) for j in range(bins.width) for k in range(bins.width)])
        return log, more, [B.raw_scores(m, x) for m in models]
    cells = both(1 << 26)
    assert not passes                       # no pass per level
    levels = both(0)
    assert passes
    for a, b in zip(cells[:2], levels[:2]):
        assert [r[:2] for r in a] == [r[:2] for r in b] and np.allclose([r[2:] for r in a], [r[2:] for r in b], equal_nan=True)
    assert all(np.allclose(a, b) for a, b in zip(cells[2], levels[2]))
