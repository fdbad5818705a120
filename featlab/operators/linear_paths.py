"""Cross-validated regularisation paths from fold moments.

One pass adds up, per fold, the products of (1, x, y): (d + 2)^2 numbers. A
training set's moments are the total minus its own fold's, so any number of
penalties and folds costs no further pass: coordinate descent runs on the
moments, warm-started from the previous penalty, and the held-out error of the
fold follows from the fold's own moments.

    1/(2n) |y - Xw - b|^2 + alpha * l1_ratio |w|_1 + alpha * (1 - l1_ratio) / 2 |w|^2

``l1_ratio`` 1 is the lasso, 0 ridge (with alpha per row), between them the
elastic net. Rows with a NULL or non-finite value are left out. Only moments,
(d + 2)^2 numbers per fold, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, np.ndarray]:
    """M'M per fold, M = (1, features, label)."""
    cols = [*features, label]
    d = len(cols) + 1

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            which = b.column(0).to_numpy()
            m = np.concatenate([np.ones((b.num_rows, 1)), b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)], 1)
            for f in np.unique(which).tolist():
                part = m[which == f]
                sums[f] = sums.get(f, 0) + part.T @ part
        for f, s in sums.items():
            yield pa.RecordBatch.from_pydict({"fold": pa.array([f] * (d * d), pa.int32()), "cell": pa.array(range(d * d), pa.int32()), "v": s.reshape(-1)})
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.select(F.col(fold).cast("int").alias("fold"), x.alias("x")) \
        .filter(F.col("fold").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(add_up, "fold int, cell int, v double").groupBy("fold", "cell").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r.fold, np.zeros((d, d))).reshape(-1)[r.cell] = r.v
    return out


@dataclass
class Fit:
    weights: np.ndarray
    intercept: float


def descend(moments: np.ndarray, alpha: float, l1_ratio: float, intercept: bool = True, start: np.ndarray | None = None,
            tol: float = 1e-10, most: int = 10_000) -> Fit:
    """Coordinate descent on the moments of (1, x, y)."""
    n = moments[0, 0]
    d = len(moments) - 2
    if not n:
        return Fit(np.zeros(d), 0.0)
    g, c = moments[1:-1, 1:-1] / n, moments[1:-1, -1] / n
    mx, my = moments[0, 1:-1] / n, moments[0, -1] / n
    if intercept:
        g, c = g - np.outer(mx, mx), c - mx * my
    w = np.zeros(d) if start is None else start.copy()
    size = np.maximum(np.diag(g), 0)
    for _ in range(most):
        moved = 0.0
        for j in range(d):
            pull = c[j] - g[j] @ w + size[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha * l1_ratio, 0)
            below = size[j] + alpha * (1 - l1_ratio)
            new = new / below if below > 0 else 0.0
            moved = max(moved, abs(new - w[j]) * np.sqrt(size[j]))
            w[j] = new
        if moved <= tol * max(1.0, np.sqrt(max(moments[-1, -1] / n, 0))):
            break
    return Fit(w, float(my - mx @ w) if intercept else 0.0)


def mean_squared_error(moments: np.ndarray, fit: Fit) -> float:
    """Of the rows the moments were made of."""
    v = np.concatenate([[-fit.intercept], -fit.weights, [1.0]])
    return float(max(v @ moments @ v, 0.0) / moments[0, 0]) if moments[0, 0] else float("nan")


def largest_alpha(moments: np.ndarray, l1_ratio: float = 1.0, intercept: bool = True) -> float:
    """The least penalty at which all lasso weights are zero."""
    n = moments[0, 0]
    c = moments[1:-1, -1] / n - (moments[0, 1:-1] / n * moments[0, -1] / n if intercept else 0)
    return float(np.max(np.abs(c)) / max(l1_ratio, 1e-3))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str, alphas: Sequence[float] | None = None,
                   l1_ratios: Sequence[float] = (1.0,), intercepts: Sequence[bool] = (True,), n_alphas: int = 100) -> tuple[dict, list[tuple]]:
    """(chosen point with the weights of all rows, log of (alpha, l1 ratio, intercept, mean held-out error)).
    Without ``alphas``: ``n_alphas`` from the largest useful one down to a thousandth of it.
    Ties go to the first point: larger penalties, then earlier ratios."""
    folds = fold_moments(df, features, label, fold)
    if not folds:
        raise ValueError("no complete rows")
    total = sum(folds.values())
    log = []
    for ratio in l1_ratios:
        for intercept in intercepts:
            top = largest_alpha(total, ratio, intercept)
            path = sorted(alphas, reverse=True) if alphas is not None else list(top * np.logspace(0, -3, n_alphas))
            errors = np.zeros(len(path))
            for own in folds.values():
                start = None
                for k, alpha in enumerate(path):
                    fit = descend(total - own, alpha, ratio, intercept, start)
                    start = fit.weights
                    errors[k] += mean_squared_error(own, fit) / len(folds)
            log += [(float(a), float(ratio), bool(intercept), float(e)) for a, e in zip(path, errors)]
    alpha, ratio, intercept, error = min(log, key=lambda r: r[3])
    fit = descend(total, alpha, ratio, intercept)
    return {"alpha": alpha, "l1_ratio": ratio, "intercept": intercept, "error": error, "fit": fit}, log


def subset_error(folds: dict[int, np.ndarray], places: Sequence[int]) -> float:
    """Mean over the folds of the held-out squared error of least squares with
    an intercept on the features at ``places`` (shortest solution where they
    depend on each other); folds without rows, or without rows outside, are left out."""
    total = sum(folds.values())
    keep = [0, *[p + 1 for p in places], len(total) - 1]
    errors = []
    for own in folds.values():
        fit, held = (total - own)[np.ix_(keep, keep)], own[np.ix_(keep, keep)]
        if fit[0, 0] > 0 and held[0, 0] > 0:
            scale = np.sqrt(np.maximum(np.diag(fit)[:-1], 1e-300))
            w = np.linalg.lstsq(fit[:-1, :-1] / np.outer(scale, scale), fit[:-1, -1] / scale, rcond=1e-12)[0] / scale
            v = np.append(-w, 1.0)
            errors.append(max(v @ held @ v, 0.0) / held[0, 0])
    return float(np.mean(errors)) if errors else float("nan")


def stepwise_linear(df: DataFrame, features: Sequence[str], label: str, fold: str, forward: bool = True) -> list[tuple[int, str, float]]:
    """F11/F12 for linear models: ``(step, feature, error)`` of every feature
    dropped (or added when ``forward``) and the cross-validated error after it;
    step 0 holds the error at the start (all features; the mean alone).
    One pass over the rows gathers the moments of the folds, (d + 2)^2 numbers
    each; every trial is read from them. A step must not raise the error; of
    equal trials the later feature is added and the earlier dropped."""
    folds = fold_moments(df, features, label, fold)
    chosen = [] if forward else list(range(len(features)))
    if not folds:
        return [(0, "", float("nan"))]
    best = subset_error(folds, chosen)
    log = [(0, "", best)]
    while True:
        moves = [k for k in range(len(features)) if k not in chosen][::-1] if forward else chosen if len(chosen) > 1 else []
        trials = [(subset_error(folds, sorted([*chosen, k]) if forward else [c for c in chosen if c != k]), n, k) for n, k in enumerate(moves)]
        if not trials or not min(trials)[0] <= best:
            return log
        best, _, k = min(trials)
        chosen = sorted([*chosen, k]) if forward else [c for c in chosen if c != k]
        log.append((len(log), features[k], best))
