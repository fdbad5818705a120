"""Operator 3, token counts by overlap resynchronisation.

Texts of up to ``chunk`` characters are counted whole. A longer one is cut into
chunks that overlap by ``2 * overlap`` characters; the chunks are separate rows,
spread over the cluster, and encoded by the library with offsets. Each reports
the places in its overlaps where a pre-token starts and how many tokens come
before them. Two neighbours are spliced at the first place that both report:

* a pre-token boundary of the left chunk is one of the whole text as soon as the
  chunk's own left splice is, and as the library could see ``margin`` further
  characters there (longer than any look-ahead of the pattern and any special
  string), so the missing rest of the text cannot change it;
* matching from a boundary on depends only on what follows it, so if the right
  chunk has a boundary at the same place, both agree from there on.

The first chunk starts at a true boundary, hence by induction all splices are
exact, and the count is the sum of the tokens between splices. If some seam of
a document has no common place (a run without boundaries), that document is
chunked again with four times the overlap, until its chunks cover it whole.

Defined results: NULL and empty texts have no tokens and no bytes; repeated rows
and NULL ids keep their own rows; an empty table gives an empty result; other
columns are ignored. Memory per task: a block of texts or a few chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featlab.llm.pieces import text_array
from featlab.llm.shared import small_batches, task_count, text_or_empty, tidy, written
from featlab.llm.tokenizers_lib import piece_encoder, tokenizer

CHUNK = 16_384
OVERLAP = 256
#: Characters the pattern may look ahead beyond a boundary (special strings come on top).
LOOK_AHEAD = 4
#: Chunks encoded in one call of the library.
BATCH = 32

_ENCODED = "rid long, k int, total long, left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>"


def _whole(docs: DataFrame, path: str, byte_level: bool) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = piece_encoder(path, byte_level)
        for b in batches:
            lens = run.lengths(text_array(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return docs.select("doc_id", "n_bytes", "text").mapInArrow(tidy(count), "doc_id long, n_bytes long, n_tokens long")


def _chunks(huge: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``rid, k, start, last, text`` per chunk."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))  # the last chunk is longer than its overlap
                for k in range(n):
                    start = max(0, k * chunk - overlap)
                    end = len(text) if k == n - 1 else (k + 1) * chunk + overlap
                    yield pa.RecordBatch.from_pydict({"rid": [rid], "k": pa.array([k], pa.int32()), "start": [start], "last": [k == n - 1], "text": [text[start:end]]})
    return huge.select("rid", "text").mapInArrow(tidy(cut), "rid long, k int, start long, last boolean, text string")


def boundaries(encoding, first: int, last: int) -> tuple[list[int], list[int]]:
    """Places in [first, last] where a pre-token starts, and the tokens before each."""
    at, before = [], []
    i = next((t for p in range(first, last + 1) if (t := encoding.char_to_token(p)) is not None), None)
    while i is not None and i < len(encoding):
        p = encoding.token_to_chars(i)[0]
        if p > last:
            break
        if p >= first and (i == 0 or encoding.token_to_word(i) != encoding.token_to_word(i - 1)):
            at.append(p)
            before.append(i)
        i += 1
    return at, before


def _encoded(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        margin = LOOK_AHEAD + max([0, *(len(a.content) for a in t.get_added_tokens_decoder().values())])
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH).to_pydict()
                rows: dict[str, list] = {c: [] for c in ("total", "left_at", "left_n", "right_at", "right_n")}
                for e, start, last, k, text in zip(t.encode_batch(part["text"], add_special_tokens=False), part["start"], part["last"], part["k"], part["text"]):
                    left = boundaries(e, 0, min(2 * overlap, len(text)) - 1) if k else ([], [])
                    right = ([], []) if last else boundaries(e, max(0, len(text) - 2 * overlap), len(text) - 1 - margin)
                    for c, v in zip(rows, (len(e), [p + start for p in left[0]], left[1], [p + start for p in right[0]], right[1])):
                        rows[c].append(v)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["rid"], pa.int64()), pa.array(part["k"], pa.int32()), pa.array(rows["total"], pa.int64()),
                     *(pa.array(rows[c], longs) for c in ("left_at", "left_n", "right_at", "right_n"))],
                    ["rid", "k", "total", "left_at", "left_n", "right_at", "right_n"])
    return chunks.repartition(task_count(chunks.sparkSession), "rid", "k").mapInArrow(tidy(encode), _ENCODED)


def _spliced(encoded: DataFrame) -> DataFrame:
    """``rid, n_tokens`` (NULL if a seam has no common boundary), ``chunks``."""
    row = Window.partitionBy("rid").orderBy("k")
    seams = encoded.withColumn("next_at", F.lead("left_at").over(row)).withColumn("next_n", F.lead("left_n").over(row)) \
        .withColumn("cut", F.array_min(F.array_intersect("right_at", "next_at")))
    # tokens before the cut in this chunk, and before the same cut in the next one
    place = lambda where, n: F.element_at(n, F.array_position(where, F.col("cut")).cast("int"))
    seams = seams.withColumn("gain", F.when(F.col("next_at").isNull(), F.col("total"))
                             .when(F.col("cut").isNotNull(), place("right_at", "right_n") - place("next_at", "next_n")))
    return seams.groupBy("rid").agg(F.when(F.count("gain") == F.count("*"), F.sum("gain")).alias("n_tokens"), F.count("*").cast("int").alias("chunks"))


def count_tokens(docs: DataFrame, path: str, byte_level: bool = True, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, chunks, overlap`` of every row, for a tokenizers .json file."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    result = _whole(rows.filter(F.length("text") <= chunk), path, byte_level).withColumn("chunks", F.lit(1)).withColumn("overlap", F.lit(0))
    huge = written(rows.filter(F.length("text") > chunk).withColumn("rid", F.monotonically_increasing_id()), "huge-texts")
    todo = huge
    while not todo.isEmpty():
        done = written(_spliced(_encoded(_chunks(todo, chunk, overlap), path, overlap)), "spliced")
        counted = huge.select("rid", "doc_id", "n_bytes").join(done.filter("n_tokens is not null"), "rid")
        result = result.unionByName(counted.select("doc_id", "n_bytes", "n_tokens", "chunks", F.lit(overlap).alias("overlap")))
        todo = todo.join(done.filter("n_tokens is null").select("rid"), "rid", "left_semi")
        overlap *= 4
        chunk = max(chunk, 2 * overlap)
    return result.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "chunks", "overlap")
