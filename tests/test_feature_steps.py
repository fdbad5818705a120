"""Stepwise selection from fold moments and one-job permutation importance, against numpy loops."""

import numpy as np
import pandas as pd
import pytest

from featlab.operators import models as MD
from featlab.operators.linear_paths import stepwise_linear


def held_out_error(x, y, fold, chosen):
    errors = []
    for f in np.unique(fold):
        a = np.column_stack([np.ones(len(y)), x[:, chosen]])
        w = np.linalg.lstsq(a[fold != f], y[fold != f], rcond=None)[0]
        errors.append(np.mean((y[fold == f] - a[fold == f] @ w) ** 2))
    return float(np.mean(errors))


@pytest.mark.parametrize("forward", [True, False])
def test_stepwise_equals_refitting_every_trial(spark, forward):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(240, 5)) * [1, 10, 0.1, 1, 1] + [0, 5, 0, 0, 0]
    x[:, 4] = x[:, 0] * 2                                    # depends on the first
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + 0.5 * rng.normal(size=240)
    fold = np.arange(240) % 4
    names = list("abcde")
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y, fold=fold.astype("int32")))
    log = stepwise_linear(df, names, "y", "fold", forward)
    chosen = [] if forward else list(range(5))
    assert log[0] == (0, "", pytest.approx(held_out_error(x, y, fold, chosen)))
    for step, name, error in log[1:]:
        k = names.index(name)
        trials = [held_out_error(x, y, fold, sorted([*chosen, j]) if forward else [c for c in chosen if c != j])
                  for j in (set(range(5)) - set(chosen) if forward else chosen)]
        chosen = sorted([*chosen, k]) if forward else [c for c in chosen if c != k]
        assert error == pytest.approx(min(trials)) and error == pytest.approx(held_out_error(x, y, fold, chosen))
    assert 1 in chosen and (0 in chosen or 4 in chosen)
    left = [held_out_error(x, y, fold, sorted([*chosen, j]) if forward else [c for c in chosen if c != j]) for j in (set(range(5)) - set(chosen) if forward else chosen)]
    assert all(e > log[-1][2] * (1 - 1e-9) for e in left)


def test_stepwise_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a double, y double, fold int")
    (step, name, error), = stepwise_linear(empty, ["a"], "y", "fold")
    assert (step, name) == (0, "") and np.isnan(error)


def test_permutation_importance_in_one_job_a_split(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 3))
    pdf = pd.DataFrame(x, columns=list("abc")).assign(id=range(200), y=4 * x[:, 0] + x[:, 1])
    got = {r.feature: r.importance for r in MD.permutation_importance(spark.createDataFrame(pdf), list("abc"), "y", "id", splits=1).collect()}
    assert got["a"] > got["b"] > abs(got["c"])
    none = MD.permutation_importance(spark.createDataFrame(pdf), ["a"], "y", "id", splits=1, fraction=0.0).first()
    assert np.isnan(none.importance)
