"""Fitted transforms on Structured Streaming frames.

The reference has no streaming operator. What carries over: every fitted
row-local or lookup transform here is lazy and action-free, so it applies
to a ``readStream`` frame unchanged - a stream-static join against the
fitted lookup table (broadcast when its fitted size allows) plus column
expressions. This module wires such transforms to a stream and sinks the
result per micro-batch (the libffm / scored-row writers work as
``foreachBatch`` bodies).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Transform = Callable[[DataFrame], DataFrame]


def stream_table(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """A Parquet directory as a stream (explicit schema, bounded batches)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def apply_fitted(stream: DataFrame, *transforms: Transform) -> DataFrame:
    """Chain fitted ``transform`` callables (mean-encoder model, label
    encoder, scalers, tokenizers) onto a streaming frame."""
    out = stream
    for t in transforms:
        out = t(out)
    return out


def run_to_memory(df: DataFrame, name: str, checkpoint: str):
    """Drain all available input into a memory table (tests / smoke)."""
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def run_foreach_batch(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Exactly-once style sink: ``sink(batch_df, epoch_id)`` per micro-batch,
    with progress recorded in ``checkpoint`` (a shared folder on a cluster)."""
    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).start()
    q.processAllAvailable()
    q.stop()
    return q
