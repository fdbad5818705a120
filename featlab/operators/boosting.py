"""Histogram gradient boosting as Spark aggregations.

Features are cut into bins once. A round grows its trees level by level: one
pass over the rows adds up gradient, Hessian and count per (model, node,
feature, bin) inside the tasks, Spark adds up the tasks' numbers and picks every
node's best split, and only the splits (one row per node) reach the driver.
All folds and all points of a parameter grid are models of the same pass, so a
cross-validated search over a grid costs ``rounds x depth`` passes, not that
many per point.

    gain  = S(left) + S(right) - S(node),  S = T(G)^2 / (H + lambda_l2)
    value = -learning_rate * T(G) / (H + lambda_l2),  T(G) = sign(G) max(|G| - lambda_l1, 0)

A split needs ``gain > min_split_gain`` and on both sides a Hessian sum of at
least ``min_child_weight`` and ``min_data_in_leaf`` rows; ties go to the first
feature, then the lowest threshold. Objectives: ``l2``, ``l1`` (gradient signs,
leaf values renewed to the median residual times the learning rate), ``binary``
(log loss) and ``softmax`` (``classes`` trees a round). Rows and columns of a
tree are drawn by seeded hashes of the row id and of the feature number.

Rows whose label is NULL or not finite are not learned from. NULL and NaN
features have a bin of their own, below all values. A model is a few numbers per
node, kept on the driver: at most ``rounds x classes x 2^depth`` nodes, as the
parameters say, whatever the number of rows. A task's memory is one batch and
``models x nodes x features x bins`` sums. Predictions are written every
``KEEP_EVERY`` rounds to the shared checkpoint folder, so a pass evaluates only
the trees since then.

For squared loss a row counts by its bins, its fold and its bag only: where these
make few different cells (``CELL_BYTES``), the rows are added up by cell in one pass,
and a task grows whole models on the cells, without a pass per level.
"""

from __future__ import annotations

import io
import itertools
import math
import pickle
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featlab.operators.stats import exact_quantiles
from featlab.session import ensure_checkpoint_dir, reliable_checkpoint, written_table
from featlab.sources.shared_files import get_array, put

#: Rounds after which the predictions of the rows are written anew.
KEEP_EVERY = 10
#: Cells of a tree's histogram that a task adds up; a larger one is handed to Spark batch by batch, filled cells only.
CELLS = 1 << 20
#: Bytes of the cells (rows with the same bins, fold and bag) that a task may hold to grow a model on its own.
CELL_BYTES = 64 << 20


@dataclass(frozen=True)
class BoostParams:
    objective: str = "l2"
    classes: int = 1
    learning_rate: float = 0.1
    max_depth: int = 3
    min_child_weight: float = 0.0
    min_data_in_leaf: int = 1
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0
    min_split_gain: float = 0.0
    feature_fraction: float = 1.0
    bagging_fraction: float = 1.0
    seed: int = 77


@dataclass
class Tree:
    """Nodes in order of creation; a node with ``feature`` -1 is a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, values: tuple[float, float]) -> tuple[int, int]:
        n = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, at, n, n + 1
        for v in values:
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(0)
            self.right.append(0)
            self.value.append(v)
        return n, n + 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, at, left, right = (np.asarray(x) for x in (self.feature, self.bin, self.left, self.right))
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            f = feature[node]
            if (f < 0).all():
                return node
            down = np.where(bins[rows, np.maximum(f, 0)] <= at[node], left[node], right[node])
            node = np.where(f < 0, node, down)

    def values_of(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(bins)]


@dataclass
class Model:
    """One boosted model: ``rounds[r][c]`` is the tree of round r and class c."""
    params: BoostParams
    held_out: int | None = None
    base: list[float] = field(default_factory=list)
    rounds: list[list[Tree]] = field(default_factory=list)

    def first(self, n: int) -> "Model":
        return replace(self, rounds=self.rounds[:n])


@dataclass(frozen=True)
class Bins:
    """Upper edges (inclusive) of each feature's bins; bin 0 is NULL, the last one is above all edges."""
    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]

    @property
    def width(self) -> int:
        return max(map(len, self.edges), default=0) + 2


def fit_bins(df: DataFrame, features: Sequence[str], max_bin: int = 255) -> Bins:
    """A bin per value where a feature has at most ``max_bin`` of them, else bins of equal shares (exact quantiles)."""
    edges = []
    for c in features:
        x = df.select(F.col(c).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
        values = [r.x for r in x.distinct().limit(max_bin + 1).collect()]
        if len(values) > max_bin:
            values = [r.value for r in exact_quantiles(x, "x", [k / max_bin for k in range(1, max_bin)]).collect()]
        edges.append(tuple(sorted(set(values))))
    return Bins(tuple(features), tuple(edges))


def binned(df: DataFrame, bins: Bins, id_cols: Sequence[str], label: str | None = None, fold: str | None = None) -> DataFrame:
    """``id..., _rid, _y, _fold, _bins`` (array of bin numbers), by a search in the edges (column expressions)."""
    def number(c: str, edges: Sequence[float]):
        x = F.col(c).cast("double")
        above = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < x)) if edges else F.lit(0)
        return F.when(x.isNull() | F.isnan(x), F.lit(0)).otherwise(above + 1).cast("int")
    y = F.col(label).cast("double") if label else F.lit(None).cast("double")
    return df.select(*id_cols, F.xxhash64(*id_cols).alias("_rid"), F.when(~F.isnan(y) & (F.abs(y) != math.inf), y).alias("_y"),
                     (F.col(fold).cast("int") if fold else F.lit(-1)).alias("_fold"),
                     F.array(*[number(c, e) for c, e in zip(bins.features, bins.edges)]).alias("_bins"))


# ---- numbers of a batch ---------------------------------------------------------------------
def _share(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per id (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) / 2.0 ** 64


def in_bag(p: BoostParams, ids: np.ndarray, round_: int) -> np.ndarray:
    return np.ones(len(ids), bool) if p.bagging_fraction >= 1 else _share(ids, p.seed * 1_000_003 + round_) < p.bagging_fraction


def tree_features(p: BoostParams, n: int, round_: int, cls: int) -> list[int]:
    """The features a tree may use: the ``feature_fraction`` with the least hashes, one at least."""
    if p.feature_fraction >= 1:
        return list(range(n))
    order = np.argsort(_share(np.arange(n), p.seed * 7_368_787 + round_ * 131 + cls), kind="stable")
    return sorted(order[:max(1, round(p.feature_fraction * n))].tolist())


def link(p: BoostParams, raw: np.ndarray) -> np.ndarray:
    """Predictions (n x classes) from raw scores."""
    if p.objective == "binary":
        return 1 / (1 + np.exp(-raw))
    if p.objective == "softmax":
        e = np.exp(raw - raw.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    return raw


def gradients(p: BoostParams, raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    got = link(p, raw)
    if p.objective == "l1":
        return np.sign(got - y[:, None]), np.ones_like(got)
    if p.objective == "l2":
        return got - y[:, None], np.ones_like(got)
    want = (y[:, None] == np.arange(p.classes)) if p.objective == "softmax" else y[:, None]
    return got - want, got * (1 - got)


def losses(p: BoostParams, raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    got = link(p, raw)
    if p.objective == "l1":
        return np.abs(got[:, 0] - y)
    if p.objective == "l2":
        return (got[:, 0] - y) ** 2
    if p.objective == "softmax":
        hit = got[np.arange(len(y)), y.astype(int)]
    else:
        hit = np.where(y > 0, got[:, 0], 1 - got[:, 0])
    return -np.log(np.maximum(hit, 1e-15))


def raw_scores(model: Model, bins: np.ndarray, start: np.ndarray | None = None, skip: int = 0) -> np.ndarray:
    out = np.tile(np.asarray(model.base, float), (len(bins), 1)) if start is None else start.copy()
    for trees in model.rounds[skip:]:
        for c, t in enumerate(trees):
            out[:, c] += t.values_of(bins)
    return out


@dataclass
class Growing:
    """A tree under construction: its open nodes and their place in the histogram."""
    model: int
    cls: int
    tree: Tree
    open: list[int]
    features: list[int]


class _Batch:
    """Arrow columns of the working table as arrays."""

    def __init__(self, batch: pa.RecordBatch, models: Sequence[Model], kept: int):
        n = batch.num_rows
        self.rid, self.y, self.fold = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        self.bins = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        base = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if kept else None
        self.raw, at = [], 0
        for m in models:
            k = len(m.base)
            self.raw.append(raw_scores(m, self.bins, base[:, at:at + k] if kept else None, kept))
            at += k


# ---- passes ---------------------------------------------------------------------------------
SUMS = "model int, cls int, node int, feature int, bin int, g double, h double, n long"


def _sums(models: list[Model], growing: list[Growing], width: int, kept: int, with_loss: bool):
    """The pass: histograms of the open nodes, and the losses so far (node and feature -1: bin 0 training, 1 held out)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: list[np.ndarray | None] = [None] * len(growing)
        lost = np.zeros((len(models), 2, 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            b = _Batch(batch, models, kept)
            train = [np.ones(len(b.y), bool) if m.held_out is None else b.fold != m.held_out for m in models]
            if with_loss:
                for k, m in enumerate(models):
                    one = losses(m.params, b.raw[k], b.y)
                    for side, rows in enumerate((train[k], ~train[k])):
                        lost[k, side] += one[rows].sum(), rows.sum()
            grads: dict[int, tuple] = {}
            for t, grow in enumerate(growing):
                m = models[grow.model]
                if grow.model not in grads:
                    grads[grow.model] = *gradients(m.params, b.raw[grow.model], b.y), train[grow.model] & in_bag(m.params, b.rid, len(m.rounds))
                g, h, used = grads[grow.model]
                place = np.full(len(grow.tree.feature), -1)
                place[grow.open] = np.arange(len(grow.open))
                at = np.where(used, place[grow.tree.leaf_of(b.bins)], -1)
                rows = np.flatnonzero(at >= 0)
                if len(grow.features) * len(grow.open) * width > CELLS:
                    for f in grow.features:
                        key, where = np.unique(at[rows] * width + b.bins[rows, f], return_inverse=True)
                        yield _rows(grow.model, grow.cls, np.asarray(grow.open)[key // width], f, key % width,
                                    *(np.bincount(where, w, len(key)) for w in (g[rows, grow.cls], h[rows, grow.cls], None)))
                    continue
                if tables[t] is None:
                    tables[t] = np.zeros((3, len(grow.features), len(grow.open) * width))
                for j, f in enumerate(grow.features):
                    key = at[rows] * width + b.bins[rows, f]
                    for i, weight in enumerate((g[rows, grow.cls], h[rows, grow.cls], None)):
                        tables[t][i, j] += np.bincount(key, weight, len(grow.open) * width)
        for t, grow in enumerate(growing):
            if tables[t] is None:
                continue
            j, cell = np.nonzero(tables[t][2])
            yield _rows(grow.model, grow.cls, np.asarray(grow.open)[cell // width], np.asarray(grow.features)[j], cell % width, *tables[t][:, j, cell])
        if with_loss and lost[..., 1].any():
            for k in range(len(models)):
                yield _rows(k, 0, -1, -1, np.arange(2), lost[k, :, 0], np.zeros(2), lost[k, :, 1])
    return run


def _rows(model: int, cls: int, node, feature, at, g, h, n) -> pa.RecordBatch:
    ints = [pa.array(np.broadcast_to(np.asarray(x), len(at)).astype(np.int32)) for x in (model, cls, node, feature, at)]
    return pa.RecordBatch.from_arrays([*ints, pa.array(np.asarray(g, float)), pa.array(np.asarray(h, float)), pa.array(np.asarray(n).astype(np.int64))],
                                      names=[c.split()[0] for c in SUMS.split(", ")])


def best_splits(sums: DataFrame, params: DataFrame) -> DataFrame:
    """One row per open node: its totals and its best allowed split (``params``: one row per model);
    one row per model with the losses, if the pass added them up (node -1)."""
    keys = ["model", "cls", "node"]
    upto = Window.partitionBy(*keys, "feature").orderBy("bin")
    whole = Window.partitionBy(*keys, "feature")
    both = sums.join(F.broadcast(params), "model") \
        .select("*", *[F.sum(c).over(upto).alias(f"{c}l") for c in "ghn"], *[F.sum(c).over(whole).alias(f"{c}t") for c in "ghn"])

    def score(g, h):
        t = F.greatest(F.abs(g) - F.col("lambda_l1"), F.lit(0.0))
        return F.when(h + F.col("lambda_l2") > 0, t * t / (h + F.col("lambda_l2"))).otherwise(0.0)
    right = {c: F.col(f"{c}t") - F.col(f"{c}l") for c in "ghn"}
    gain = score(F.col("gl"), F.col("hl")) + score(right["g"], right["h"]) - score(F.col("gt"), F.col("ht"))
    allowed = (F.col("feature") >= 0) & (F.col("nl") >= F.greatest(F.col("min_data_in_leaf"), F.lit(1))) & (right["n"] >= F.greatest(F.col("min_data_in_leaf"), F.lit(1))) \
        & (F.col("hl") >= F.col("min_child_weight")) & (right["h"] >= F.col("min_child_weight")) & (F.col("gain") > F.col("min_split_gain"))
    best = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", "nl")
    lost = F.array(*[F.struct(F.max(F.when(F.col("bin") == side, F.col("g"))).alias("sum"), F.max(F.when(F.col("bin") == side, F.col("n"))).alias("n")) for side in (0, 1)])
    return both.withColumn("gain", gain).groupBy(*keys).agg(
        F.when(F.col("node") < 0, lost).alias("lost"), F.max(F.when(allowed, best)).alias("best"), F.max(F.struct(-F.col("feature"), F.col("gt").alias("g"), F.col("ht").alias("h"), F.col("nt").alias("n"))).alias("total"))


def _leaf(p: BoostParams, g: float, h: float) -> float:
    t = max(abs(g) - p.lambda_l1, 0.0)
    return -p.learning_rate * math.copysign(t, g) / (h + p.lambda_l2) if h + p.lambda_l2 > 0 else 0.0


def _base_scores(data: DataFrame, models: list[Model]) -> None:
    """Start values of models that have none: mean, median, log odds or log shares of their training rows."""
    wanted = [m for m in models if not m.base]
    if not wanted:
        return
    aggs = []
    for k, m in enumerate(wanted):
        y = F.col("_y") if m.held_out is None else F.when(F.col("_fold") != m.held_out, F.col("_y"))
        if m.params.objective == "l1":
            aggs.append(F.percentile_approx(y, 0.5, 10_000).alias(f"b{k}_0"))
        elif m.params.objective == "softmax":
            aggs += [F.avg((y == c).cast("double")).alias(f"b{k}_{c}") for c in range(m.params.classes)]
        else:
            aggs.append(F.avg(y).alias(f"b{k}_0"))
    row = data.agg(*aggs).first()
    for k, m in enumerate(wanted):
        found = [float(row[f"b{k}_{c}"] or 0.0) for c in range(m.params.classes)]
        if m.params.objective in ("binary", "softmax"):
            found = [min(max(x, 1e-6), 1 - 1e-6) for x in found]
            found = [math.log(x / (1 - x)) if m.params.objective == "binary" else math.log(x) for x in found]
        m.base = found


def _renewed(data: DataFrame, models: list[Model], growing: list[Growing], kept: int) -> None:
    """L1: leaf values become the median residual of the leaf's rows, times the learning rate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            b = _Batch(batch, models, kept)
            for t, grow in enumerate(growing):
                m = models[grow.model]
                used = in_bag(m.params, b.rid, len(m.rounds)) & (b.fold != m.held_out if m.held_out is not None else True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(used.sum(), t, np.int32)), pa.array(grow.tree.leaf_of(b.bins[used]).astype(np.int32)),
                                                  pa.array(b.y[used] - b.raw[grow.model][used, grow.cls])], names=["t", "leaf", "r"])
    found = data.mapInArrow(run, "t int, leaf int, r double").groupBy("t", "leaf").agg(F.percentile_approx("r", 0.5, 10_000).alias("r"))
    for r in found.collect():  # one row per leaf
        grow = growing[r.t]
        grow.tree.value[r.leaf] = models[grow.model].params.learning_rate * r.r


# ---- squared loss on cells ------------------------------------------------------------------
@dataclass
class Cells:
    """Rows added up by bins and fold: ``n``, ``s``, ``q`` are the count, sum and sum of squares of the labels less
    ``shift``; ``bag_n`` and ``bag_s`` (round x class x cell) those of the rows of a bag class: class c are the rows
    in the bags of the fractions from the c-th on."""
    fold: np.ndarray
    bins: np.ndarray
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    bag_n: np.ndarray
    bag_s: np.ndarray
    shift: float

    def weights(self, fraction: float, fractions: Sequence[float], round_: int) -> tuple[np.ndarray, np.ndarray]:
        if fraction >= 1:
            return self.n, self.s
        upto = fractions.index(fraction) + 1
        return self.bag_n[round_, :upto].sum(axis=0), self.bag_s[round_, :upto].sum(axis=0)


def _cells(rows: DataFrame, bins: Bins, models: list[Model], rounds: int) -> tuple[str, list[float]] | None:
    """The folder with the file of the cells, and the bagging fractions below 1; None where there are too many cells."""
    d, width = len(bins.features), bins.width
    fractions = sorted({m.params.bagging_fraction for m in models if m.params.bagging_fraction < 1})
    seeds = {m.params.seed for m in models if m.params.bagging_fraction < 1}
    if len(seeds) > 1 or d * math.log2(width) > 60:
        return None
    began, classes, seed = len(models[0].rounds), len(fractions), next(iter(seeds), 0)
    known = rows.filter(F.col("_y").isNotNull())
    first = known.agg(F.avg("_y").alias("y"), F.approx_count_distinct(F.struct("_fold", "_bins")).alias("n")).first()
    each = 8 * (d + 4 + 2 * rounds * classes)
    if not first.n or first.n * each > CELL_BYTES:
        return None
    shift = float(first.y)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            rid, y, fold, key = map(np.concatenate, zip(*held))
            for r in range(-1, rounds if classes else 0):   # -1: all rows
                bag = np.zeros(len(y), np.int64) if r < 0 else np.searchsorted(fractions, _share(rid, seed * 1_000_003 + began + r), "right")
                order = np.lexsort((key, fold, bag))
                b, f, k = bag[order], fold[order], key[order]
                at = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (f[1:] != f[:-1]) | (k[1:] != k[:-1])]))
                z = y[order]
                out = [f[at], k[at], b[at], np.diff(np.append(at, len(z))), np.add.reduceat(z, at), np.add.reduceat(z * z, at)]
                keep = slice(None) if r < 0 else out[2] < classes   # rows in no bag count in round -1 only
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out[0][keep]), r, np.int32)), pa.array(out[0][keep].astype(np.int32)), pa.array(out[1][keep]),
                                                  pa.array(out[2][keep].astype(np.int32)), pa.array(out[3][keep]), pa.array(out[4][keep]), pa.array(out[5][keep])],
                                                 names=["r", "fold", "key", "bag", "n", "s", "q"])
        held, count = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.int64)
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy() - shift, b.column(2).to_numpy(zero_copy_only=False), x @ (width ** np.arange(d, dtype=np.int64))))
            count += b.num_rows
            if count >= CELLS:
                yield from sums(held)
                held, count = [], 0
        if held:
            yield from sums(held)
    found = written_table(known.select("_rid", "_y", "_fold", "_bins").mapInArrow(add_up, "r int, fold int, key long, bag int, n long, s double, q double")
                          .groupBy("r", "fold", "key", "bag").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")))
    cells = found.filter("r < 0").count()
    if cells * each > CELL_BYTES:
        return None
    folder = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/cells-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches([b for b in batches if b.num_rows])
        r, fold, key, bag, n, s, q = (t.column(c).to_numpy() for c in ("r", "fold", "key", "bag", "n", "s", "q"))
        all_ = np.flatnonzero(r < 0)
        all_ = all_[np.lexsort((key[all_], fold[all_]))]
        names = np.array(list(zip(fold[all_], key[all_])), dtype=[("f", np.int64), ("k", np.int64)])
        want = np.zeros(len(r), names.dtype)
        want["f"], want["k"] = fold, key
        at, some = np.searchsorted(names, want), r >= 0
        bag_n, bag_s = np.zeros((2, rounds * bool(classes), classes, len(all_)))
        bag_n[r[some], bag[some], at[some]], bag_s[r[some], bag[some], at[some]] = n[some], s[some]
        out = io.BytesIO()
        np.savez(out, fold=fold[all_], bins=(key[all_][:, None] // width ** np.arange(d, dtype=np.int64)) % width, n=n[all_].astype(float), s=s[all_], q=q[all_], bag_n=bag_n, bag_s=bag_s, shift=shift)
        put(folder, "cells", [out.getvalue()], "one")
        yield from ()
    found.coalesce(1).mapInArrow(write, "done int").write.format("noop").mode("overwrite").save()   # at most CELL_BYTES
    return folder, fractions


def _grown(model: Model, cells: Cells, fractions: list[float], rounds: int, width: int) -> list[tuple[float, float]]:
    """Adds ``rounds`` rounds to the model; (training loss, held-out loss) of every round, the start first."""
    p = model.params
    train = np.ones(len(cells.n), bool) if model.held_out is None else cells.fold != model.held_out
    if not model.base:
        n = cells.n[train].sum()
        model.base = [cells.shift + float(cells.s[train].sum() / n) if n else 0.0]
    raw, log = raw_scores(model, cells.bins)[:, 0] - cells.shift, []
    least = max(p.min_data_in_leaf, 1)

    def score(g, h):
        t = np.maximum(np.abs(g) - p.lambda_l1, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + p.lambda_l2 > 0, t * t / (h + p.lambda_l2), 0.0)
    for r in range(rounds + 1):
        lost = cells.q - 2 * raw * cells.s + raw * raw * cells.n
        log.append(tuple(float(lost[side].sum() / cells.n[side].sum()) if side.any() else math.nan for side in (train, ~train)))
        if r == rounds:
            return log
        n, s = cells.weights(p.bagging_fraction, fractions, r)
        rows = np.flatnonzero(train & (n > 0))
        n, g, bins = n[rows], (n * raw - s)[rows], cells.bins[rows]
        tree, node, features = Tree(), np.zeros(len(rows), np.int64), tree_features(p, bins.shape[1], len(model.rounds), 0)
        open_ = np.array([0] if len(rows) else [], np.int64)
        for depth in range(p.max_depth):
            # the cells of the open nodes, node by node
            live = np.flatnonzero(np.isin(node, open_))
            live = live[np.argsort(node[live], kind="stable")]
            starts = np.searchsorted(node[live], open_)
            following = []
            step = max(1, CELLS // width)
            for a in range(0, len(open_), step):
                nodes = open_[a:a + step]
                part = live[starts[a]:starts[a + step] if a + step < len(open_) else len(live)]
                at, shape = np.searchsorted(nodes, node[part]), (len(nodes), width)
                best = np.full(len(nodes), -np.inf), *(np.zeros(len(nodes)) for _ in range(4))
                total = None
                for f in features:
                    key = at * width + bins[part, f]
                    gl, nl = (np.cumsum(np.bincount(key, w[part], shape[0] * width).reshape(shape), axis=1) for w in (g, n))
                    gt, nt = gl[:, -1:], nl[:, -1:]
                    total = (gl[:, -1], nl[:, -1]) if total is None else total
                    gain = score(gl, nl) + score(gt - gl, nt - nl) - score(gt, nt)
                    allowed = (nl >= least) & (nt - nl >= least) & (nl >= p.min_child_weight) & (nt - nl >= p.min_child_weight) & (gain > p.min_split_gain)
                    gain = np.where(allowed, gain, -np.inf)
                    cut = gain.argmax(axis=1)
                    i = np.arange(len(nodes))
                    better = gain[i, cut] > best[0]
                    for to, new in zip(best, (gain[i, cut], np.full(len(nodes), f), cut, gl[i, cut], nl[i, cut])):
                        to[better] = new[better]
                if depth == 0:
                    tree.value[0] = _leaf(p, float(total[0][0]), float(total[1][0]))
                for i in np.flatnonzero(np.isfinite(best[0])).tolist():
                    gl, nl = float(best[3][i]), float(best[4][i])
                    following.extend(tree.split(int(nodes[i]), int(best[1][i]), int(best[2][i]), (_leaf(p, gl, nl), _leaf(p, float(total[0][i]) - gl, float(total[1][i]) - nl))))
            feature, cut, left, right = (np.asarray(x) for x in (tree.feature, tree.bin, tree.left, tree.right))
            f = feature[node[live]]
            down = np.where(bins[live, np.maximum(f, 0)] <= cut[node[live]], left[node[live]], right[node[live]])
            node[live] = np.where(f < 0, node[live], down)
            open_ = np.array(sorted(following), np.int64)
            if not len(open_):
                break
        model.rounds.append([tree])
        raw = raw + tree.values_of(cells.bins)


def _train_on_cells(spark, folder: str, fractions: list[float], width: int, models: list[Model], rounds: int, keep: bool) -> list[tuple[int, int, float, float]]:
    """``train`` by one task per model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = None
        for b in batches:
            for k in b.column(0).to_pylist():
                if cells is None:
                    z = np.load(io.BytesIO(get_array(folder, "cells", np.uint8).tobytes()))
                    cells = Cells(**{c: z[c] for c in z.files if c != "shift"}, shift=float(z["shift"]))
                model = models[k]
                began = len(model.rounds)
                log = _grown(model, cells, fractions, rounds, width)
                yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "train": pa.array([[a for a, _ in log]], pa.list_(pa.float64())), "held": pa.array([[x for _, x in log]], pa.list_(pa.float64())),
                                                  "model": pa.array([pickle.dumps((model.base, model.rounds[began:])) if keep else None], pa.binary())})
    numbers = spark.createDataFrame([(k,) for k in range(len(models))], "k int").repartition(len(models))
    log = []
    for r in numbers.mapInArrow(run, "k int, train array<double>, held array<double>, model binary").collect():   # one row per model
        log += [(r.k, len(models[r.k].rounds) + i, a, b) for i, (a, b) in enumerate(zip(r.train, r.held))]
        if keep:
            base, trees = pickle.loads(r.model)
            models[r.k].base = base
            models[r.k].rounds.extend(trees)
    return sorted(log)


def train(rows: DataFrame, bins: Bins, models: list[Model], rounds: int, patience: int | None = None,
          groups: Sequence[int] | None = None, stop=None, keep: bool = True) -> list[tuple[int, int, float, float]]:
    """Adds up to ``rounds`` rounds to every model (in place) and returns (model, round, training loss,
    held-out loss) of every round, round 0 being the start. ``rows``: a table of ``binned``. Models of one
    group stop together when their mean held-out loss has not improved for ``patience`` rounds;
    ``stop(model, round, training loss)`` may end a single model. Without ``keep`` only the losses are wanted."""
    spark = rows.sparkSession
    if len({len(m.rounds) for m in models}) > 1:
        raise ValueError("models of one call must have as many rounds")
    if patience is None and stop is None and models and all(m.params.objective == "l2" and m.params.classes == 1 for m in models):
        found = _cells(rows, bins, models, rounds)
        if found is not None:
            return _train_on_cells(spark, *found, bins.width, models, rounds, keep)
    groups = list(range(len(models))) if groups is None else list(groups)
    data = reliable_checkpoint(rows.filter(F.col("_y").isNotNull()).select("_rid", "_y", "_fold", "_bins", F.array().cast("array<double>").alias("_raw")))
    _base_scores(data, models)
    log: list[tuple[int, int, float, float]] = []
    began = [len(m.rounds) for m in models]
    best: dict[int, tuple[float, int]] = {}
    active, kept = list(range(len(models))), 0
    fields = ("lambda_l1", "lambda_l2", "min_split_gain", "min_child_weight", "min_data_in_leaf")
    for r in range(rounds + 1):
        now = [models[k] for k in active]
        growing = [Growing(i, c, Tree(), [0], tree_features(m.params, len(bins.features), len(m.rounds), c))
                   for i, m in enumerate(now) for c in range(m.params.classes)] if r < rounds else []
        params = spark.createDataFrame([(i, *[float(getattr(m.params, f)) for f in fields]) for i, m in enumerate(now)],
                                       "model int, " + ", ".join(f"{f} double" for f in fields))
        depth = 0
        while depth == 0 or any(g.open for g in growing):
            sums = data.mapInArrow(_sums(now, [g for g in growing if g.open], bins.width, kept, depth == 0), SUMS) \
                .groupBy("model", "cls", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
            by = {(g.model, g.cls): g for g in growing}
            following: dict[tuple[int, int], list[int]] = {}
            for row in best_splits(sums, params).collect():  # one row per open node, and per model
                if row.node < 0:
                    (a, na), (b, nb) = row.lost
                    log.append((active[row.model], r, a / na if na else math.nan, b / nb if nb else math.nan))
                    continue
                grow = by[row.model, row.cls]
                p = now[grow.model].params
                if depth == 0:
                    grow.tree.value[0] = _leaf(p, row.total.g, row.total.h)
                if row.best is not None:
                    s = row.best
                    values = _leaf(p, s.gl, s.hl), _leaf(p, row.total.g - s.gl, row.total.h - s.hl)
                    following.setdefault((row.model, row.cls), []).extend(grow.tree.split(row.node, -s.f, -s.b, values))
            if not depth:
                ended = _ended(log, groups, active, best, r, patience, stop)
            depth += 1
            for g in growing:
                g.open = following.get((g.model, g.cls), []) \
                    if depth < now[g.model].params.max_depth and active[g.model] not in ended else []
        if r == rounds:
            break
        renew = [g for g in growing if now[g.model].params.objective == "l1" and active[g.model] not in ended]
        if renew:
            _renewed(data, now, renew, kept)
        trees: dict[int, list[Tree]] = {}
        for g in growing:
            trees.setdefault(g.model, []).append(g.tree)
        for i, k in enumerate(active):
            if k not in ended:
                models[k].rounds.append(trees[i])
        active = [k for k in active if k not in ended]
        if not active:
            break
        if (r + 1) % KEEP_EVERY == 0 or kept and ended:
            data, kept = _kept(data, [models[k] for k in active]), len(models[active[0]].rounds)
    return sorted((k, began[k] + r, a, b) for k, r, a, b in log)


def _kept(data: DataFrame, models: list[Model]) -> DataFrame:
    """The working table with the raw scores of ``models`` so far (all have as many rounds)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                raw = np.concatenate([raw_scores(m, bins) for m in models], axis=1)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, raw.size + 1, raw.shape[1]), pa.int32()), pa.array(raw.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(4)], flat], names=batch.schema.names)
    return reliable_checkpoint(data.mapInArrow(run, data.schema))


def _ended(log, groups, active, best, r, patience, stop) -> set[int]:
    """Models that take no further round after the losses of round ``r``."""
    latest = {k: (a, b) for k, q, a, b in log if q == r}
    ended = {k for k in active if stop is not None and stop(k, r, latest[k][0])}
    if patience is not None:
        for g in {groups[k] for k in active}:
            mean = float(np.mean([latest[k][1] for k in active if groups[k] == g]))
            if g not in best or mean < best[g][0]:
                best[g] = mean, r
            elif r - best[g][1] >= patience:
                ended |= {k for k in active if groups[k] == g}
    return ended


# ---- use ------------------------------------------------------------------------------------
def fit(df: DataFrame, features: Sequence[str], label: str, id_cols: Sequence[str], params: BoostParams, rounds: int,
        max_bin: int = 255, bins: Bins | None = None) -> tuple[Model, Bins]:
    """One model on all rows with a label."""
    bins = bins or fit_bins(df, features, max_bin)
    model = Model(params)
    train(binned(df, bins, id_cols, label), bins, [model], rounds)
    return model, bins


def predict(df: DataFrame, model: Model, bins: Bins, id_cols: Sequence[str]) -> DataFrame:
    """``id..., score`` (array of one value, or of the class probabilities), for every row."""
    ready = binned(df, bins, id_cols).select(*id_cols, "_bins")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields[:-1]], "score array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = link(model.params, raw_scores(model, b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, got.size + 1, got.shape[1]), pa.int32()), pa.array(got.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(b.num_columns - 1)], flat], names=[*b.schema.names[:-1], "score"])
    return ready.mapInArrow(run, schema)


def trees_table(spark, model: Model, bins: Bins) -> DataFrame:
    """The model as rows: ``round, class, node, feature, threshold, left, right, value`` (a leaf has no feature)."""
    rows = []
    for r, trees in enumerate(model.rounds):
        for c, t in enumerate(trees):
            for node in range(len(t.feature)):
                f = t.feature[node]
                leaf = f < 0
                at = None if leaf else -math.inf if t.bin[node] == 0 else bins.edges[f][t.bin[node] - 1]
                rows.append((r + 1, c, node, None if leaf else bins.features[f], at, None if leaf else t.left[node], None if leaf else t.right[node], float(t.value[node])))
    return spark.createDataFrame(rows, "round int, class int, node int, feature string, threshold double, left int, right int, value double")


def cross_validate(df: DataFrame, features: Sequence[str], label: str, id_cols: Sequence[str], fold: str, grid: Sequence[BoostParams],
                   rounds: int, patience: int | None = None, bins: Bins | None = None, max_bin: int = 255) -> list[tuple[int, float]]:
    """(best round, its mean held-out loss) of every point of ``grid``, all points and folds in the same passes."""
    bins = bins or fit_bins(df, features, max_bin)
    rows = reliable_checkpoint(binned(df, bins, id_cols, label, fold))
    folds = [r[0] for r in rows.select("_fold").distinct().orderBy("_fold").collect()]  # one row per fold
    models = [Model(p, f) for p in grid for f in folds]
    groups = [g for g in range(len(grid)) for _ in folds]
    log = train(rows, bins, models, rounds, patience, groups, keep=False)
    out = []
    for g in range(len(grid)):
        per: dict[int, list[float]] = {}
        for k, r, _, b in log:
            if groups[k] == g and r:
                per.setdefault(r, []).append(b)
        means = {r: float(np.mean(x)) for r, x in per.items()}
        out.append(min(((r, m) for r, m in means.items()), key=lambda x: (x[1], x[0])))
    return out


#: M03's groups, in the order they are tuned, with the grids they are tuned over.
TUNING_GROUPS: tuple[tuple[str, dict[str, tuple]], ...] = (
    ("depth", {"max_depth": (3, 5, 7, 9, 12, 15, 17, 25)}),
    ("child_weight", {"min_child_weight": (1, 3, 5, 7)}),
    ("fractions", {"feature_fraction": (0.6, 0.7, 0.8, 0.9, 1.0), "bagging_fraction": (0.6, 0.7, 0.8, 0.9, 1.0)}),
    ("lambdas", {"lambda_l1": (0.0, 0.1, 0.5, 1.0), "lambda_l2": (0.0, 0.01, 0.1, 1.0), "min_split_gain": (0.0, 1.0)}),
)


def tune(df: DataFrame, features: Sequence[str], label: str, id_cols: Sequence[str], fold: str, base: BoostParams, rounds: int,
         patience: int | None = None, groups=TUNING_GROUPS, max_bin: int = 255) -> tuple[BoostParams, int, DataFrame]:
    """Group after group, all its grid points with the best values so far; every point is scored
    and the best (the earlier on ties) kept. (parameters, rounds, log)."""
    bins = fit_bins(df, features, max_bin)
    best, best_loss, best_rounds, log = base, math.inf, rounds, []
    for name, axes in groups:
        grid = [replace(best, **dict(zip(axes, point))) for point in itertools.product(*axes.values())]
        scored = cross_validate(df, features, label, id_cols, fold, grid, rounds, patience, bins)
        k = min(range(len(grid)), key=lambda i: scored[i][1])
        for i, (r, loss) in enumerate(scored):
            point = {a: float(getattr(grid[i], a)) for a in axes}
            log.append((name, i, point, r, loss, i == k and loss <= best_loss))
        if scored[k][1] <= best_loss:
            best, best_rounds, best_loss = grid[k], *scored[k]
    table = df.sparkSession.createDataFrame(log, "group string, point int, params map<string,double>, rounds int, loss double, chosen boolean")
    return best, best_rounds, table


def continue_until(df: DataFrame, model: Model, bins: Bins, label: str, id_cols: Sequence[str], target: float,
                   within: float = 0.001, most: int = 100) -> list[tuple[int, float]]:
    """Goes on training a fitted model (in place) on ``df`` until its training loss is below ``target``
    or within ``within`` of it, at most ``most`` more rounds. (round, training loss) from where it began."""
    model.held_out = None
    log = train(binned(df, bins, id_cols, label), bins, [model], most, stop=lambda k, r, loss: loss < target + within)
    return [(r, a) for _, r, a, _ in log]
