"""Polynomial and robust fits per facet.

All facets are fitted together. A round is one aggregation of weighted moments
per facet (x and y are centred and scaled per facet first, so that powers stay
well conditioned) and a small solve per facet inside the tasks. A robust fit
repeats it with Huber weights ``min(1, 1.345 s / |residual|)``, ``s`` being the
facet's median absolute residual / 0.6745, until the facet's coefficients move
by less than ``tol``; facets that are done take no further part. Facets are
joined back by their key, never collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.session import reliable_checkpoint, written_table

#: Huber's constant and the ratio of median absolute deviation to standard deviation (fixed values).
HUBER, MAD = 1.345, 0.6745
#: A table of at most so many facets is sent to all tasks.
BROADCAST_ROWS = 10_000


def _few(facets: DataFrame, rows: int) -> DataFrame:
    """A row per facet: few facets are sent to the rows, so that the rows of a large facet stay where they are."""
    return F.broadcast(facets) if rows <= BROADCAST_ROWS else facets


def _power(x: Column, k: int) -> Column:
    out = F.lit(1.0)
    for _ in range(k):
        out = out * x
    return out


def _solve(keyed: DataFrame, order: int) -> DataFrame:
    """``_fl_key, _fl_m`` (moments of z^0 .. z^2p, then z^k t) to ``_fl_key, _fl_c`` (coefficients)."""
    p = order + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                index = np.arange(p)[:, None] + np.arange(p)
                out = [np.linalg.lstsq(row[:2 * p - 1][index], row[2 * p - 1:], rcond=None)[0].tolist() for row in m]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float64()))], names=["_fl_key", "_fl_c"])
    return keyed.select("_fl_key", "_fl_m").mapInArrow(run, "_fl_key string, _fl_c array<double>")


def _moments(rows: DataFrame, order: int, weight: Column) -> DataFrame:
    z, t = F.col("_fl_z"), F.col("_fl_t")
    sums = [F.sum(weight * _power(z, k)) for k in range(2 * order + 1)] + [F.sum(weight * _power(z, k) * t) for k in range(order + 1)]
    return rows.groupBy("_fl_key").agg(F.array(*sums).alias("_fl_m"))


def fitted_polynomials(df: DataFrame, y: str, x: str, by: Sequence[str] = (), order: int = 1, robust: bool = False,
                       tol: float = 1e-8, most: int = 50) -> DataFrame:
    """``by..., coefficients`` (of x^0, x^1, ...), ``n, rounds``. Rows with a NULL or non-finite x or y are left
    out; a facet with fewer distinct x than coefficients gets the least-norm fit of its centred powers."""
    by = list(by)
    key = F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)]), {"ignoreNullFields": "false"}) if by else F.lit("")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    base = df.select(*by, key.alias("_fl_key"), F.col(x).cast("double").alias("_fl_x"), F.col(y).cast("double").alias("_fl_y")) \
        .filter(finite(F.col("_fl_x")) & finite(F.col("_fl_y")))
    spread = lambda c: F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(1.0)
    facets = reliable_checkpoint(base.groupBy("_fl_key", *by).agg(F.avg("_fl_x").alias("_fl_mx"), spread("_fl_x").alias("_fl_sx"), F.avg("_fl_y").alias("_fl_my"),
                                                                  spread("_fl_y").alias("_fl_sy"), F.count(F.lit(1)).alias("n")))
    count = facets.limit(BROADCAST_ROWS + 1).count()
    scaled = base.select("_fl_key", "_fl_x", "_fl_y").join(_few(facets.drop("n", *by), count), "_fl_key") \
        .select("_fl_key", ((F.col("_fl_x") - F.col("_fl_mx")) / F.col("_fl_sx")).alias("_fl_z"), ((F.col("_fl_y") - F.col("_fl_my")) / F.col("_fl_sy")).alias("_fl_t"))
    if robust:
        scaled = written_table(scaled)
    now = _solve(_moments(scaled, order, F.lit(1.0)), order).withColumn("rounds", F.lit(1))
    if robust:
        now = reliable_checkpoint(now)
        done = None
        for r in range(2, most + 1):
            fit = F.aggregate(F.zip_with("_fl_c", F.sequence(F.lit(0), F.lit(order)), lambda c, k: c * F.pow(F.col("_fl_z"), k.cast("double"))), F.lit(0.0), lambda s, v: s + v)
            rows = scaled.join(_few(now.select("_fl_key", "_fl_c"), count), "_fl_key").withColumn("_fl_r", F.abs(F.col("_fl_t") - fit))
            scale = rows.groupBy("_fl_key").agg((F.percentile_approx("_fl_r", 0.5, 10_000) / MAD).alias("_fl_s"))
            cut = F.col("_fl_s") * HUBER
            weight = F.when((F.col("_fl_r") <= cut) | (cut <= 0), 1.0).otherwise(cut / F.col("_fl_r"))
            new = _solve(_moments(rows.join(_few(scale, count), "_fl_key"), order, weight), order)
            moved = F.aggregate(F.zip_with("_fl_c", "_fl_old", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: F.greatest(s, v))
            step = reliable_checkpoint(new.join(now.select("_fl_key", F.col("_fl_c").alias("_fl_old")), "_fl_key")
                                       .select("_fl_key", "_fl_c", F.lit(r).alias("rounds"), (moved < tol).alias("_fl_done")))
            ended = step.filter("_fl_done").drop("_fl_done")
            done = ended if done is None else done.unionByName(ended)
            now = step.filter("not _fl_done").drop("_fl_done")
            if now.isEmpty():
                break
        now = now if done is None else done.unionByName(now)
    # from the scaled polynomial in z = (x - mx) / sx back to powers of x
    def choose(k: int, j: int) -> float:
        from math import comb
        return float(comb(k, j))
    powers = []
    for j in range(order + 1):
        terms = [F.col("_fl_c")[k] * choose(k, j) * _power(-F.col("_fl_mx"), k - j) / _power(F.col("_fl_sx"), k) for k in range(j, order + 1)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        powers.append(total * F.col("_fl_sy") + (F.col("_fl_my") if j == 0 else F.lit(0.0)))
    return facets.join(now, "_fl_key").select(*by, F.array(*powers).alias("coefficients"), "n", "rounds")
