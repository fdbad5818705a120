"""Shuffled, padded batches of every epoch without a sort per epoch.

Rows are numbered once. An epoch's order is a keyed permutation of the numbers
(Feistel rounds over a rectangle of n1 x n2 >= n places; places beyond n are
walked on until one below n comes), so a row knows its batch in every epoch from
its own number: only the rows of one batch meet, to be padded to its longest.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featlab.operators.ordering import global_rank

#: Alternating rounds, and the modulus and multiplier of their mixing function.
ROUNDS = 6
PRIME = 2147483647
MULTIPLIER = 48271
#: Places walked at most; there are fewer than n1 places beyond n, hit with a chance of about 1 / n2 each.
WALK = 64


def _mixed(x: Column, key: Column, round_: int) -> Column:
    """A number below PRIME from a number and the epoch's key (products stay below 2^63)."""
    y = ((x + key + (round_ * 7919 + 1)) % PRIME) * MULTIPLIER % PRIME
    return (y * y + y) % PRIME


def permuted(x: Column, n: int, key: Column) -> Column:
    """The place of number ``x`` (0 .. n - 1) in the order that ``key`` (0 .. PRIME - 1) gives."""
    if n <= 1:
        return F.lit(0).cast("long")
    n1 = math.isqrt(n - 1) + 1
    n2 = -(-n // n1)

    def once(at: Column) -> Column:
        # a struct, so that each half is computed once per round
        state = F.struct(F.floor(at / n2).cast("long").alias("l"), (at % n2).cast("long").alias("r"))

        def step(s: Column, k: Column) -> Column:
            left = ((s["l"] + _mixed(s["r"], key + k * 104729, 0)) % n1).cast("long")
            return F.transform(F.array(left), lambda v: F.struct(v.alias("l"), ((s["r"] + _mixed(v, key + k * 104729, 1)) % n2).cast("long").alias("r")))[0]
        out = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), state, step)
        return F.transform(F.array(out), lambda s: s["l"] * n2 + s["r"])[0]
    start = F.struct(x.cast("long").alias("at"), F.lit(False).alias("done"))

    def walk(s: Column, _: Column) -> Column:
        return F.when(s["done"], s).otherwise(F.transform(F.array(once(s["at"])), lambda v: F.struct(v.alias("at"), (v < n).alias("done")))[0])
    end = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, walk)
    return F.transform(F.array(end), lambda s: F.when(s["done"], s["at"]).otherwise(F.raise_error(F.lit("no place found")).cast("long")))[0]


def epoch_batches(df: DataFrame, order_by: Sequence, batch_size: int, epochs: int, seed: int = 42, drop_remainder: bool = False,
                  num_partitions: int | None = None) -> DataFrame:
    """Every row once per epoch, with ``epoch`` (from 0), ``batch`` and ``place`` in the batch.
    ``order_by`` must be a total order. The last batch is short, or dropped."""
    ranked = global_rank(df, order_by, "_fl_rank", num_partitions=num_partitions, size_col="_fl_n")
    n = int(ranked.agg(F.max("_fl_n")).first()[0] or 0)
    key = F.pmod((F.col("epoch") + 1) * 1_000_003 + seed, F.lit(PRIME))
    rows = ranked.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) \
        .withColumn("_fl_place", permuted(F.col("_fl_rank") - 1, n, key))
    if drop_remainder:
        rows = rows.filter(F.col("_fl_place") < n // batch_size * batch_size)
    return rows.withColumn("batch", F.expr(f"_fl_place div {batch_size}")).withColumn("place", F.col("_fl_place") % batch_size) \
        .drop("_fl_rank", "_fl_n", "_fl_place")


def padded_batches(batches: DataFrame, sequences: Sequence[str], pad, batch_cols: Sequence[str] = ("epoch", "batch")) -> DataFrame:
    """Q03: array columns padded with ``pad`` to the longest of their batch; ``<name>_length`` keeps the length.
    A group is one batch."""
    group = Window.partitionBy(*batch_cols)
    out = batches
    for c in sequences:
        n = F.coalesce(F.size(c), F.lit(0))
        out = out.withColumn(f"{c}_length", F.when(F.col(c).isNull(), 0).otherwise(n))
    for c in sequences:
        longest = F.max(f"{c}_length").over(group)
        out = out.withColumn(f"_fl_{c}", longest).withColumn(c, F.concat(F.coalesce(c, F.array().cast(batches.schema[c].dataType)),
                                                                        F.array_repeat(F.lit(pad).cast(batches.schema[c].dataType.elementType), F.col(f"_fl_{c}") - F.col(f"{c}_length")))).drop(f"_fl_{c}")
    return out
