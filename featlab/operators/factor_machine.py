"""Factorization machine on parsed feature rows (M08 over E10), by alternating least squares.

    score = w0 + sum_j w_j x_j + 1/2 sum_f [(sum_j v_jf x_j)^2 - sum_j (v_jf x_j)^2]

Rows carry one (index, value) pair per field, so given all other fields the
score is linear in (w_j, v_j1 .. v_jk) of a field's features, and no row holds
two of them. A step therefore solves all features of one field exactly: one
aggregation per index of the moments of x (1, q), q being the other fields' sum
of v x, a ridge solve of (k + 1) numbers per index inside the tasks, and one
join of the new rows back. No vector of the dictionary's width exists; factor
tables are joined, broadcast only where their counted rows are few.

Squared loss with penalty ``l2`` on w and v. Rows with a NULL target are not
learned from; an index that was not seen in training scores 0; NULL or
non-finite values count as 0. Starting factors are counter-based draws, so a
fit depends on rows, not on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.functions import draws
from featlab.session import reliable_checkpoint, written_table

#: A factor table of at most so many counted rows is sent to all tasks.
BROADCAST_ROWS = 100_000


@dataclass
class FactorMachine:
    w0: float
    table: DataFrame          # idx, w, v (array of k)
    k: int
    losses: list[float]       # mean squared training error after each sweep


def _sized(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _value(f: int) -> Column:
    x = F.col("xv")[f].cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), x).otherwise(0.0)


def _attach(rows: DataFrame, table: DataFrame, f: int, k: int) -> DataFrame:
    """Columns ``_l{f}`` (w x) and ``_q{f}`` (v x) of field ``f``; 0 for an unknown index."""
    t = table.select(F.col("idx").alias("_idx"), F.col("w").alias("_w"), F.col("v").alias("_v"))
    x = _value(f)
    return rows.join(_sized(t), F.col("xi")[f] == F.col("_idx"), "left") \
        .withColumn(f"_l{f}", F.coalesce(F.col("_w") * x, F.lit(0.0))) \
        .withColumn(f"_q{f}", F.coalesce(F.transform("_v", lambda a: a * x), F.array_repeat(F.lit(0.0), k))).drop("_idx", "_w", "_v")


def _score(w0: float, fields: int, k: int) -> Column:
    linear = F.lit(w0)
    for f in range(fields):
        linear = linear + F.col(f"_l{f}")
    pairs = F.lit(0.0)
    for a in range(k):
        total = square = F.lit(0.0)
        for f in range(fields):
            total, square = total + F.col(f"_q{f}")[a], square + F.col(f"_q{f}")[a] * F.col(f"_q{f}")[a]
        pairs = pairs + (total * total - square) / 2
    return linear + pairs


def _solved(rows: DataFrame, f: int, fields: int, k: int, w0: float, l2: float) -> DataFrame:
    """New ``idx, w, v`` of the field's features, all others fixed."""
    x = _value(f)
    others = [g for g in range(fields) if g != f]
    basis = [F.lit(1.0)]
    for a in range(k):
        q = F.lit(0.0)
        for g in others:
            q = q + F.col(f"_q{g}")[a]
        basis.append(q)
    rest = F.lit(w0)  # the score without this field: field columns of the others only
    for g in others:
        rest = rest + F.col(f"_l{g}")
    for a in range(k):
        square = F.lit(0.0)
        for g in others:
            square = square + F.col(f"_q{g}")[a] * F.col(f"_q{g}")[a]
        rest = rest + (basis[a + 1] * basis[a + 1] - square) / 2
    named = rows.select(F.col("xi")[f].alias("idx"), x.alias("x"), (F.col("y") - rest).alias("r"), *[b.alias(f"b{i}") for i, b in enumerate(basis)]).filter(F.col("idx").isNotNull())
    n = k + 1
    sums = [F.sum(F.col("x") * F.col("x") * F.col(f"b{i}") * F.col(f"b{j}")) for i in range(n) for j in range(i, n)]
    sums += [F.sum(F.col("x") * F.col(f"b{i}") * F.col("r")) for i in range(n)]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            a = np.zeros((b.num_rows, n, n))
            i, j = np.triu_indices(n)
            a[:, i, j] = a[:, j, i] = m[:, :len(i)]
            a[:, np.arange(n), np.arange(n)] += max(l2, 1e-12)
            t = np.linalg.solve(a, m[:, len(i):, None])[..., 0]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(t[:, 0]), pa.array(t[:, 1:].tolist(), pa.list_(pa.float64()))], names=["idx", "w", "v"])
    return named.groupBy("idx").agg(F.array(*sums).alias("m")).mapInArrow(solve, "idx long, w double, v array<double>")


def start_table(table: DataFrame, k: int, seed: int, scale: float = 0.1) -> DataFrame:
    """``idx, w, v`` before the first step: no weights, small random factors."""
    return table.select("idx", F.lit(0.0).alias("w"), F.array(*[draws.normal(seed, "idx", a, 0.0, scale) for a in range(k)]).alias("v"))


def fit(rows: DataFrame, indices: DataFrame, fields: int, k: int = 4, sweeps: int = 3, l2: float = 1.0, seed: int = 7) -> FactorMachine:
    """``rows``: ``y``, ``xi``, ``xv`` (arrays with a place per field); ``indices``: ``idx`` of every feature
    (the feature dictionary), each in one field."""
    y = F.col("y").cast("double")
    state = rows.filter(y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf"))).select(y.alias("y"), "xi", "xv")
    table = reliable_checkpoint(start_table(indices.select(F.col("idx").cast("long").alias("idx")).distinct(), k, seed))
    for f in range(fields):
        state = _attach(state, table, f, k)
    state = written_table(state)
    w0, losses = 0.0, []
    for _ in range(sweeps):
        w0 = float(state.agg(F.avg(F.col("y") - _score(0.0, fields, k))).first()[0] or 0.0)
        for f in range(fields):
            new = reliable_checkpoint(_solved(state, f, fields, k, w0, l2))
            table = reliable_checkpoint(table.join(_sized(new.select("idx")), "idx", "left_anti").unionByName(new))
            state = written_table(_attach(state.drop(f"_l{f}", f"_q{f}"), new, f, k))
        error = F.col("y") - _score(w0, fields, k)
        losses.append(float(state.agg(F.avg(error * error)).first()[0] or 0.0))
    return FactorMachine(w0, table, k, losses)


def predict(rows: DataFrame, model: FactorMachine, fields: int, keep: list[str]) -> DataFrame:
    """``keep..., score`` of every row with ``xi, xv``."""
    out = rows.select(*keep, "xi", "xv")
    for f in range(fields):
        out = _attach(out, model.table, f, model.k)
    return out.select(*keep, _score(model.w0, fields, model.k).alias("score"))
