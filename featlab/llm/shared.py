"""Helpers the training-data operators share: scratch tables, column handling, word rules."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featlab.session import ensure_checkpoint_dir

#: ASCII white space; words are runs of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A writer of a scratch table buffers so much (the default is 128 MB a task).
ROW_GROUP_BYTES = 16 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and
    a lost executor costs a read instead of a recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    """The text column, NULL as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def task_count(spark: SparkSession) -> int:
    """Partitions for explicit exchanges: the session's shuffle setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: A list of keys up to this many bytes (64 a row, key and a few numbers) is sent to every executor;
#: a longer one is joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def sized(keys: DataFrame) -> DataFrame:
    """``keys`` (a written table), marked for broadcast if its counted rows fit ``BROADCAST_BYTES``."""
    return F.broadcast(keys) if keys.count() * 64 <= BROADCAST_BYTES else keys


def free_name(docs: DataFrame, wish: str) -> str:
    """``wish``, or it with underscores behind it, so that ``docs`` has no such column."""
    while wish.lower() in {c.lower() for c in docs.columns}:
        wish += "_"
    return wish


def without(docs: DataFrame, id_col: str, dropped: DataFrame, name: str, text_hash: Column | None = None) -> DataFrame:
    """``docs`` minus the rows whose id is in ``dropped`` (one id column; with
    ``text_hash``, an expression over ``docs``, a hash column too, and both must
    match; then a NULL id matches NULL). The texts are shuffled only if the
    dropped ids are too many to broadcast."""
    names = [free_name(docs, "_dropped_id"), free_name(docs, "_dropped_hash")][:len(dropped.columns)]
    ids = written(dropped.toDF(*names), name)
    if text_hash is None:
        return docs.join(sized(ids), docs[id_col] == F.col(names[0]), "left_anti")
    return docs.join(sized(ids), docs[id_col].eqNullSafe(F.col(names[0])) & (text_hash == F.col(names[1])), "left_anti")


def one_of_each(docs: DataFrame, id_col: str, repeated: DataFrame, text_hash: Column, name: str) -> DataFrame:
    """``docs`` with one row of each (id, text hash) in ``repeated`` (two columns, distinct, few) and all
    other rows. Only the repeated rows are grouped, combined map-side."""
    names = [free_name(docs, "_dropped_id"), free_name(docs, "_dropped_hash")]
    pairs = written(repeated.toDF(*names), name)
    if pairs.isEmpty():
        return docs
    same = docs[id_col].eqNullSafe(F.col(names[0])) & (text_hash == F.col(names[1]))
    twins = docs.join(sized(pairs), same).groupBy(*names).agg(F.first(F.struct(*[docs[c] for c in docs.columns])).alias("_row"))
    return docs.join(sized(pairs), same, "left_anti").unionByName(twins.select("_row.*"))


#: Functions whose results a Python worker remembers between partitions.
_REMEMBERING: list = []
_SERVING: list = [None]


def remembered(maxsize: int):
    """``lru_cache`` for what tasks open (vocabularies, encoders). Workers outlive a stage, so ``tidy``
    forgets all of it as soon as a worker serves another module's tasks."""
    def wrap(fn):
        kept = functools.lru_cache(maxsize=maxsize)(fn)
        _REMEMBERING.append(kept)
        return kept
    return wrap


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Keep the Arrow batches that go to Python tasks near ``most`` bytes
    (long texts would make batches of many MB in the JVM and in Python)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def give_back_memory() -> None:
    """Return this process' freed memory to the system: Python workers stay
    alive between stages, and several share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that hands back freed memory when its partition is done."""
    owner = run.__module__

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from featlab.llm import shared  # the worker's own module, not a copy sent along
        if shared._SERVING[0] != owner:
            shared._SERVING[0] = owner
            for kept in shared._REMEMBERING:
                kept.cache_clear()
            give_back_memory()
        try:
            yield from run(batches)
        finally:
            give_back_memory()
    return whole
