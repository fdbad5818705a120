"""Operator 8, BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus' most frequent pre-tokens (counted over all documents, ``lexicon_size``
of them) are compiled with their ids into an automaton (``lexicon``), which every
task maps from the shared folder. A block of texts is cut into distinct pieces
(``pieces``), the pieces into pre-tokens; those in the lexicon take their ids from
it, all others are merged exactly by the rank table. So the lexicon only saves
merges and never changes a result, and no id comes from another implementation.

Merging repeats the lowest-ranked adjacent pair, leftmost first: for all short
words of a block at once, one merge of every word per step on arrays; for long
ones with a heap over a linked list, O(n log n) for a word of any length. Special strings of the vocabulary file become their ids wherever they
stand, as its library does by default. Decoding joins the ids' bytes and reads
them as UTF-8, invalid sequences as U+FFFD.

Defined results: NULL and empty text have no ids and decode to ''; NULL ids and
repeated rows keep their own rows; an empty table gives an empty result (and an
empty lexicon); other columns are ignored. Memory per task: one block of texts
and the remembered pieces.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.llm import lexicon
from featlab.llm.pieces import PieceEncoder, text_array
from featlab.llm.shared import remembered, shared_folder, small_batches, text_or_empty, tidy, written

#: The published pattern that cuts text before byte-level merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEXICON_SIZE = 50_000
#: Pieces a worker remembers between blocks (merging is cheap, memory is not).
MEMO_PIECES = 150_000
#: From this many symbols a word is merged with a heap.
LONG = 48
NO_RANK = np.iinfo(np.int32).max
HASH = 1_000_003


@functools.lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest takes letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE .json file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.single = np.asarray([vocab[c] for c in letters], np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.bytes[k] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, k in self.specials.items():
            self.bytes[k] = token.encode()
        self.words = regex.compile(PATTERN)
        # the merges as arrays: rank -> id, and a hash table of pairs -> rank
        self.spread = size
        self.merged_id = np.zeros(len(model["merges"]), np.int64)
        self.slots = np.full(1 << max(4, (8 * len(self.merge)).bit_length()), -1, np.int64)
        self.slot_rank = np.zeros(len(self.slots), np.int32)
        for (a, b), (rank, new) in self.merge.items():
            self.merged_id[rank] = new
            at = (a * size + b) * HASH & (len(self.slots) - 1)
            while self.slots[at] >= 0:
                at = at + 1 & (len(self.slots) - 1)
            self.slots[at], self.slot_rank[at] = a * size + b, rank

    def pre_tokens(self, piece: str) -> list[str | int]:
        """Pre-tokens of a piece in order; a special string is its id."""
        if (piece[1:] if piece[:1] == " " else piece).isalpha():
            return [piece]
        if self.special is None or not self.special.search(piece):
            return self.words.findall(piece)
        out: list[str | int] = []
        for k, part in enumerate(self.special.split(piece)):
            out += [self.specials[part]] if k % 2 else self.words.findall(part)
        return out

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token by exact merging."""
        return self._merge_long(self.single[np.frombuffer(word, np.uint8)].tolist())

    def merged_all(self, words: list[bytes]) -> list:
        """Ids of many pre-tokens; words of like length are merged together."""
        out: list = [None] * len(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero((lens >= LONG) | (lens == 0)):
            out[k] = self.merged(words[k])
        for length in np.unique(lens[(lens < LONG) & (lens > 0)]):
            rows = np.flatnonzero(lens == length)
            ids = self.single[np.frombuffer(b"".join([words[k] for k in rows]), np.uint8)].reshape(len(rows), length)
            for done, found in self._merge_rows(ids):
                for k, f in zip(rows[done].tolist(), found):
                    out[k] = f
        return out

    def _merge_rows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, their ids) as rows run out of merges; each step merges one pair of every other row."""
        row = np.arange(len(ids))
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(ids):
            if not rank.shape[1]:
                yield row, ids
                return
            at = rank.argmin(axis=1)
            line = np.arange(len(ids))
            best = rank[line, at]
            stop = best == NO_RANK
            if stop.any():
                yield row[stop], ids[stop]
                go = ~stop
                row, ids, rank, at, best = row[go], ids[go], rank[go], at[go], best[go]
                line = line[:len(row)]
            n, width = ids.shape
            ids[line, at] = self.merged_id[best]
            keep = np.ones((n, width), bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            # the pair's own place goes; its neighbours get new ranks
            keep = np.ones((n, width - 1), bool)
            keep[line, at] = False
            rank = rank[keep].reshape(n, width - 2)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            rank[before, at[before] - 1] = self.ranks(ids[before, at[before] - 1], ids[before, at[before]])
            rank[after, at[after]] = self.ranks(ids[after, at[after]], ids[after, at[after] + 1])

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK for pairs that do not merge (open addressing over a fixed table)."""
        key = a * self.spread + b
        slot = key * HASH & (len(self.slots) - 1)
        found = self.slots[slot]
        out = np.where(found == key, self.slot_rank[slot], NO_RANK)
        on = np.nonzero((found != key) & (found >= 0))
        while len(on[0]):
            slot[on] = slot[on] + 1 & (len(self.slots) - 1)
            found = self.slots[slot[on]]
            hit = found == key[on]
            out[tuple(x[hit] for x in on)] = self.slot_rank[slot[tuple(x[hit] for x in on)]]
            more = ~hit & (found >= 0)
            on = tuple(x[more] for x in on)
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, find = len(ids), self.merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], k, m[1], a, b) for k, (a, b) in enumerate(zip(ids, ids[1:])) if (m := find((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, k, new, a, b = heapq.heappop(heap)
            right = after[k]
            if ids[k] != a or right >= n or ids[right] != b:
                continue  # one of the two has been merged meanwhile
            ids[k], ids[right], after[k] = new, -1, after[right]
            if after[right] < n:
                before[after[right]] = k
                if m := find((new, ids[after[k]])):
                    heapq.heappush(heap, (m[0], k, m[1], new, ids[after[k]]))
            if before[k] >= 0 and (m := find((ids[before[k]], new))):
                heapq.heappush(heap, (m[0], before[k], m[1], ids[before[k]], new))
        return [i for i in ids if i >= 0]

    def encoder(self, words: lexicon.Lexicon):
        """``encode`` for PieceEncoder: lexicon first, exact merges for the rest."""
        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            cut = [self.pre_tokens(p) for p in pieces]
            number: dict[str | int, int] = {}
            flat = np.asarray([number.setdefault(w, len(number)) for c in cut for w in c], np.int64)
            distinct = list(number)
            encoded = [w.encode("utf-8", "surrogatepass") if isinstance(w, str) else b"" for w in distinct]
            ranks = words.ranks(encoded)
            known = ranks >= 0
            ids, lens = words.outputs(ranks[known])
            chunks = np.split(ids, np.cumsum(lens)[:-1]) if known.any() else []
            found: list = [None] * len(distinct)
            for k, c in zip(np.flatnonzero(known), chunks):
                found[k] = c
            rest = [k for k in np.flatnonzero(~known).tolist() if isinstance(distinct[k], str)]
            for k, f in zip(rest, self.merged_all([encoded[k] for k in rest])):
                found[k] = f
            for w in self.specials.values():
                if w in number:
                    found[number[w]] = [w]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            table = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
            starts = np.cumsum(sizes) - sizes
            lens = sizes[flat]
            ends = np.cumsum(lens)
            total = int(ends[-1]) if len(ends) else 0
            out = table[np.repeat(starts[flat] - (ends - lens), lens) + np.arange(total)] if total else np.zeros(0, np.int64)
            per = np.fromiter(map(len, cut), np.int64, len(cut))
            sums = np.concatenate([[0], ends])
            last = np.cumsum(per)
            return out.astype(np.uint32), sums[last] - sums[last - per]
        return encode

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@remembered(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@remembered(2)
def lexicon_encoder(path: str, folder: str) -> PieceEncoder:
    return PieceEncoder(vocabulary(path).encoder(lexicon.Lexicon.open(folder)), byte_level=True, memo_pieces=MEMO_PIECES)


def frequent_words(docs: DataFrame, size: int, text_col: str = "text") -> list[str]:
    """The ``size`` most frequent pre-tokens of all texts (ties by spelling).

    Pieces are counted per block in Arrow and summed per task, then by Spark;
    only the top list reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(0))
            if not len(texts):
                continue
            words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ").flatten()
            seen = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays([seen.field(0).cast(pa.string()), seen.field(1).cast(pa.int64())], ["piece", "n"])
    pieces = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(tidy(count), "piece string, n long") \
        .filter("piece <> ''").groupBy("piece").agg(F.sum("n").alias("n"))
    # a piece is a word behind a space, with or without punctuation at its end
    words = written(pieces.select(F.explode(F.regexp_extract_all(F.concat(F.lit(" "), F.col("piece")), F.lit(r"( ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+)"), F.lit(1))).alias("word"), "n")
                    .groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")
    # a histogram of the counts (eighths of powers of two, 512 rows at most) shows
    # from which count on the list has its length, so tasks sort and send little more than it
    step = F.floor(F.log2("n") * 8)
    enough, cutoff = 0, 0
    for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect():
        enough, cutoff = enough + r["words"], r["step"]
        if enough >= size:
            break
    top = words.filter(step >= cutoff).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"] for r in top.select("word").collect()]


def compile_lexicon(docs: DataFrame, path: str, size: int = LEXICON_SIZE, text_col: str = "text") -> str:
    """Build the lexicon of ``docs`` for the vocabulary; returns its folder."""
    words = sorted({w.encode() for w in frequent_words(docs, size, text_col)})
    folder = shared_folder(docs.sparkSession, "bpe-lexicon")
    lexicon.save(folder, words, [vocabulary(path).merged(w) for w in words])
    return folder


def _encoding(path: str, folder: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = lexicon_encoder(path, folder)
        for batch in batches:
            at = 0
            for ids, lens in run(text_array(batch.column(1))):
                raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(lens) * 4).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(lens)), pa.array([raw[a:b] for a, b in zip([0, *ends], ends)], pa.binary())], ["doc_id", "ids"])
                at += len(lens)
    return encode


def _decoding(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = pa.array([v.decode(np.frombuffer(b, "<u4").tolist()) for b in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["doc_id", "ids", "text"])
    return decode


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def encode_rows(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each text as little-endian 32-bit integers in one binary."""
    return _rows(docs, id_col, text_col).mapInArrow(tidy(_encoding(path, folder)), "doc_id long, ids binary")


def decode_rows(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` for the rows of ``encode_rows``."""
    return encoded.mapInArrow(tidy(_decoding(path)), "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, path: str, lexicon_size: int = LEXICON_SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, text`` (decoded from the ids) of every document; both steps run in one worker."""
    small_batches(docs.sparkSession, 2 << 20)
    folder = compile_lexicon(docs, path, lexicon_size, text_col)
    encode, decode = _encoding(path, folder), _decoding(path)
    return _rows(docs, id_col, text_col).mapInArrow(tidy(lambda batches: decode(encode(batches))), "doc_id long, ids binary, text string")


def digests(rows: DataFrame, *also: str) -> DataFrame:
    return rows.select("doc_id", *also, F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
