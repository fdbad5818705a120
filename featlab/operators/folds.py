"""Fold, batch and split assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.operators.ordering import global_rank


def block_of(rank: Column, n: Column, k: int) -> Column:
    """0-based block of a 1-based rank when ``n`` rows are cut into ``k``
    contiguous blocks, the first ``n % k`` one row longer (same sizes as
    SQL ``ntile``)."""
    q = F.floor(n / k)
    r = n % k
    big = r * (q + 1)
    i = rank - 1
    return (F.when(i < big, F.floor(i / (q + 1)))
             .otherwise(r + F.floor((i - big) / F.greatest(q, F.lit(1))))).cast("int")


def kfold(df: DataFrame, order_by: Sequence, k: int = 5, fold_col: str = "fold",
          num_partitions: int | None = None) -> DataFrame:
    """Plain k-fold: contiguous blocks of the ``order_by`` order."""
    ranked = global_rank(df, order_by, "_fl_rank", num_partitions=num_partitions, size_col="_fl_n")
    return ranked.withColumn(fold_col, block_of(F.col("_fl_rank"), F.col("_fl_n"), k)).drop("_fl_rank", "_fl_n")


def stratified_kfold(df: DataFrame, label_col: str, order_by: Sequence, k: int = 5,
                     fold_col: str = "fold", seed: int | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Stratified k-fold: contiguous blocks per class (W09). With ``seed``
    the order inside a class is a seeded hash of the order key (shuffled
    folds that are reproducible and partition-independent)."""
    keys = list(order_by)
    if seed is not None:
        keys = [F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in keys]), *keys]
    ranked = global_rank(df, keys, "_fl_rank", partition_by=[label_col],
                         num_partitions=num_partitions, size_col="_fl_n")
    return ranked.withColumn(fold_col, block_of(F.col("_fl_rank"), F.col("_fl_n"), k)).drop("_fl_rank", "_fl_n")


def hash_fold(id_col: str, k: int, seed: int = 42) -> Column:
    """Scale default: fold from a seeded hash of the id (no ordering pass)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k)).cast("int")


def split_flag(id_col: str, test_fraction: float = 0.2, seed: int = 42, buckets: int = 1_000_000) -> Column:
    """True for the validation share: md5 bucket of ``"<seed>-<id>"`` below
    the fraction (portable, reproducible in any engine with md5)."""
    from featlab.functions.hashing import md5_mod
    key = F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string"))
    return md5_mod(key, buckets) < int(test_fraction * buckets)


def hash_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed: int = 42):
    """Deterministic train/validation split on the id."""
    flagged = df.withColumn("_fl_u", F.when(split_flag(id_col, test_fraction, seed), 0.0).otherwise(1.0))
    return (flagged.filter(F.col("_fl_u") >= test_fraction).drop("_fl_u"),
            flagged.filter(F.col("_fl_u") < test_fraction).drop("_fl_u"))


def batches(df: DataFrame, order_by: Sequence, batch_size: int, batch_col: str = "batch",
            drop_remainder: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Batch numbers over an ordered set (W10); the last batch is short,
    or dropped when ``drop_remainder`` (training)."""
    ranked = global_rank(df, order_by, "_fl_rank", num_partitions=num_partitions, size_col="_fl_n")
    out = ranked.withColumn(batch_col, F.floor((F.col("_fl_rank") - 1) / batch_size).cast("bigint"))
    if drop_remainder:
        out = out.filter(F.col("_fl_rank") <= F.floor(F.col("_fl_n") / batch_size) * batch_size)
    return out.drop("_fl_rank", "_fl_n")


def shuffle_key(id_col: str, seed: int = 42) -> Column:
    """Seeded pseudo-random sort key: md5 of ``"<seed>-<id>"`` folded to 31
    bits (portable: any engine with md5 reproduces the order)."""
    from featlab.functions.hashing import md5_mod
    return md5_mod(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")), 2147483647)


def shuffle_order(df: DataFrame, id_col: str, seed: int = 42, order_col: str = "shuffle_rank",
                  num_partitions: int | None = None) -> DataFrame:
    """Seeded shuffle (R05): rank by a hash of the id (ties by id); aligned
    columns stay aligned because they are one row."""
    return global_rank(df, [shuffle_key(id_col, seed), F.col(id_col)], order_col,
                       num_partitions=num_partitions)
