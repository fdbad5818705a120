"""Operator 7, token-id output: flat unsigned integer files plus 64-bit document offsets.

``write_token_files`` range-partitions the texts by id (ascending order over
partitions and inside each), encodes them and writes per partition

    ``<part>.ids``      the ids back to back, little-endian, 2 bytes each if the
                        vocabulary has at most 65,536 entries, else 4
    ``<part>.offsets``  64-bit places, counted in ids from the part's first, one
                        more than documents
    ``<part>.docs``     the 64-bit document ids in the same order

and returns the manifest, one row per partition, whose ``base`` (ids before the
partition) is the prefix sum of the parts' counts. A part is written under a
temporary name and renamed, so a repeated or doubled task leaves the same file.
``read_token_files`` maps the files and yields documents from them.

Defined results: NULL or empty text holds the end id only; NULL ids come first
(the manifest counts them); equal ids are ordered by text; an empty table writes
nothing and gives an empty manifest; other columns are not read. Files lie in
the shared folder; memory is one block of texts and its ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featlab.llm.shared import shared_folder, small_batches, task_count, text_or_empty, tidy, written
from featlab.llm.store import get_array, open_folder, put
from featlab.llm.tokenizers_lib import piece_encoder, tokenizer


def write_token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int | None = 2,
                      byte_level: bool = False, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """(manifest, folder). ``vocabulary``: a tokenizers .json file; ``end_id``
    is appended to each document (None: nothing)."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_folder(spark, "token-files")
    width = 2 if max(tokenizer(vocabulary).get_vocab_size(), end_id or 0) <= 1 << 16 else 4

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, attempt = f"{task.partitionId():06d}", str(task.taskAttemptId())
        encode = piece_encoder(vocabulary, byte_level)
        keys: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        nulls = 0

        def ids() -> Iterator[bytes]:
            nonlocal nulls
            for batch in batches:
                if not batch.num_rows:
                    continue
                nulls += batch.column(0).null_count
                keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                for found, lens in encode(batch.column(1).cast(pa.large_string())):
                    if end_id is not None:
                        found = np.insert(found, np.cumsum(lens), end_id)
                        lens = lens + 1
                    sizes.append(lens)
                    yield found.astype(f"<u{width}").tobytes()
        put(folder, f"{name}.ids", ids(), attempt)
        if not keys:
            files, path = open_folder(folder)
            files.delete_file(f"{path}/{name}.ids")
            return
        ends = np.cumsum(np.concatenate([[0], *sizes])).astype("<i8")
        put(folder, f"{name}.offsets", [ends.tobytes()], attempt)
        put(folder, f"{name}.docs", [np.concatenate(keys).tobytes()], attempt)
        yield pa.RecordBatch.from_pydict({"part": [name], "docs": [len(ends) - 1], "null_docs": [nulls], "ids": [int(ends[-1])], "width": [width]})

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .repartitionByRange(task_count(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    parts = written(ordered.mapInArrow(tidy(write_part), "part string, docs long, null_docs long, ids long, width long"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    manifest = written(parts.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))), "token-manifest")
    return manifest, folder


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files
    (crc32 of its ids as little-endian unsigned 32-bit integers)."""
    def read(frames: Iterator) -> Iterator:
        import pandas as pd  # here, so that workers that only write do not load it
        for frame in frames:
            for p in frame.itertuples():
                ids = get_array(folder, f"{p.part}.ids", f"<u{p.width}")
                ends = get_array(folder, f"{p.part}.offsets", "<i8")
                docs = pd.Series(get_array(folder, f"{p.part}.docs", "<i8")).astype("Int64")
                docs[: p.null_docs] = pd.NA
                for k in range(0, p.docs, 10_000):
                    e = ends[k:min(k + 10_000, p.docs) + 1].tolist()
                    yield pd.DataFrame({
                        "doc_id": docs[k:k + 10_000], "start": p.base + np.asarray(e[:-1], np.int64), "n_tokens": np.diff(e),
                        "ids_crc32": [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(e, e[1:])]})
    n = max(1, task_count(manifest.sparkSession))
    return manifest.repartition(n, "part").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
