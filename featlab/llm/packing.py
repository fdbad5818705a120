"""Operator 11, packing: sum-of-squares online packing of documents into windows of tokens.

Every task packs the documents of its partition as they come. ``counts[h]`` is
the number of open windows that hold ``h`` tokens. A document of ``s`` tokens
goes into the fill level whose choice leaves the least sum of squared counts
(a new window is level 0; a window that becomes full leaves the array), ties
to the fullest window. Documents longer than a window first fill windows of
their own; the rest of them is placed like a document.

Cutting is allowed, so no window is padded: windows still open at the end of a
partition (or more than ``open_windows`` at once, which bounds a task's memory)
are laid end to end, fullest first, and cut at the window length. What is left
of a partition, less than one window, becomes sequences whose lengths are powers
of two, which need no padding either.

Sequence numbers: each task numbers its own; the base of a partition is the
prefix sum of the earlier partitions' counts, over a table of one row per
partition. The pieces are written once to the shared folder before they are
numbered, so a repeated task cannot change them, and no text is shuffled.

Defined results: NULL or empty text is the end id alone; every row is packed,
also repeated ones and those with a NULL id (ids need not be unique); an empty
table gives no piece; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featlab.llm.shared import sized, small_batches, text_or_empty, tidy, written
from featlab.llm.tokenizers_lib import piece_encoder

WINDOW = 2048
#: Windows a task keeps open at most (8 MB of ids); beyond it they are laid end to end and cut.
OPEN_WINDOWS = 1024
#: Pieces handed to Spark at a time.
ROWS = 4096

#: doc_id, ids before the piece, ids of the piece (little-endian), tokens of the document
Piece = tuple[int | None, int, bytes, int]
OUT = "part int, doc_id long, start long, length long, doc_tokens long, sequence long, offset long, ids binary"


class Packer:
    """Online packing of one partition; ``closed`` gets finished windows, each a list of pieces."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.open_windows = window, open_windows
        self.counts = np.zeros(window + 1, np.int64)
        self.at: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self.closed.append([(doc_id, start, ids[start:start + self.window].tobytes(), total)])
            start += self.window
        if start < total:
            self._place((doc_id, start, ids[start:].tobytes(), total), total - start)

    def level(self, size: int) -> int:
        """The level (0: a new window) that leaves the least sum of squared counts."""
        counts, top = self.counts, self.window - size
        # moving a window from h to h + size changes the sum by 2 (after - before) + 2,
        # by one less if it was new or becomes full, as those are not in the array
        change = 2 * (counts[size:] - counts[:top + 1]) + 2
        change[0] -= 1
        change[top] -= 1
        change[1:][counts[1:top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def _place(self, piece: Piece, size: int) -> None:
        h = self.level(size)
        if h:
            window = self.at[h].pop()
            self.counts[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        self._put(window, h + size)
        if self.n_open > self.open_windows:
            self._lay_out()

    def _put(self, window: list[Piece], level: int) -> None:
        if level == self.window:
            self.closed.append(window)
        else:
            self.at.setdefault(level, []).append(window)
            self.counts[level] += 1
            self.n_open += 1

    def _take_open(self) -> list[Piece]:
        pieces = [p for h in sorted(self.at, reverse=True) for window in self.at[h] for p in window]
        self.at, self.n_open = {}, 0
        self.counts[:] = 0
        return pieces

    def _lay_out(self) -> None:
        """All open windows end to end, cut at the window length; less than one stays open."""
        left, fill = cut(self._take_open(), [self.window], self.closed)
        if fill:
            self._put(left, fill)

    def finish(self) -> None:
        """Close everything: whole windows, then powers of two."""
        left, fill = cut(self._take_open(), [self.window], self.closed)
        sizes = [1 << k for k in reversed(range(fill.bit_length())) if fill >> k & 1]
        if sizes:
            cut(left, sizes, self.closed)


def cut(pieces: list[Piece], sizes: list[int], closed: list[list[Piece]]) -> tuple[list[Piece], int]:
    """Fill windows of ``sizes`` (the last one repeats) with ``pieces`` in order; the unfilled rest and its length."""
    window: list[Piece] = []
    fill = n = 0
    for doc_id, start, ids, total in pieces:
        while ids:
            size = sizes[min(n, len(sizes) - 1)]
            taken = ids[:4 * (size - fill)]
            window.append((doc_id, start, taken, total))
            fill += len(taken) // 4
            start += len(taken) // 4
            ids = ids[len(taken):]
            if fill == size:
                closed.append(window)
                window, fill, n = [], 0, n + 1
    return window, fill


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = 1, open_windows: int = OPEN_WINDOWS,
         byte_level: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start`` (its document's ids before it),
    ``length, doc_tokens, sequence_id, offset`` (place in the sequence) and
    ``ids`` (little-endian unsigned 32-bit)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = piece_encoder(vocabulary, byte_level)
        packer = Packer(window, open_windows)
        sequence = 0

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            done, packer.closed = packer.closed, []
            out: list[list] = [[] for _ in range(8)]
            for pieces in done:
                offset = 0
                for doc_id, start, ids, total in pieces:
                    n = len(ids) // 4
                    for column, value in zip(out, (part, doc_id, start, n, total, sequence, offset, ids)):
                        column.append(value)
                    offset += n
                sequence += 1
                if len(out[0]) >= ROWS:
                    yield _batch(out)
                    out = [[] for _ in range(8)]
            if out[0]:
                yield _batch(out)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = iter(batch.column(0).to_pylist())
            for found, lens in encode(batch.column(1).cast(pa.large_string())):
                found = np.insert(found, np.cumsum(lens), end_id).astype("<u4")
                ends = np.cumsum(lens + 1).tolist()
                for a, b in zip([0, *ends], ends):
                    packer.add(next(keys), found[a:b])
                yield from rows()
        packer.finish()
        yield from rows()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    pieces = written(texts.mapInArrow(tidy(run), OUT), "packed-pieces")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = pieces.groupBy(F.col("part").alias("_part")).agg((F.max("sequence") + 1).alias("_n"))
    bases = written(parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "packed-bases")
    return pieces.join(sized(bases), F.col("part") == F.col("_part")).select(
        "doc_id", "start", "length", "doc_tokens", (F.col("_base") + F.col("sequence")).alias("sequence_id"), "offset", "ids")


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in OUT.split(", ")])


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The training rows: ``sequence_id, ids, length, padded_length`` (a group is one window at most)."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.aggregate(ordered, F.lit(b""), lambda got, p: F.concat(got, p["ids"])).alias("ids"),
                                              F.sum("length").alias("length"))
    power = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    return whole.withColumn("padded_length", F.when(power, F.col("length")).otherwise(F.lit(window).cast("long")))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the unsigned crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
