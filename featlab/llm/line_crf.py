"""Operator 10, quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its emission score is linear in features of its own
text and of the lines before and after it; a 2x2 transition matrix couples
neighbouring lines. Forward-backward gives each line's marginal probability to
be good, and the document's score is their mean weighted by line length.

Training maximises the conditional likelihood (gradient: expected minus seen
feature counts, by the same forward-backward) with every line of a labelled
document carrying the document's label. It uses at most ``SAMPLE_DOCS`` labelled
documents, the first in the order of md5(id), with at most ``SAMPLE_LINES`` lines;
that bounded sample is all the driver sees. Scoring covers whole texts, block by
block, in Spark tasks; the model is a few hundred numbers in the closure.

Features are counts of the text alone: shares of upper case, digits, symbol
classes and white space, word lengths, distinct and repeated words, lines that
occur again in the document, sentence ends. Labels, language, source and ids are
no inputs.

Defined results: NULL and empty texts are one empty line and get the score the
chain gives it; NULL ids and repeated rows keep their own rows; a document
labelled more than once counts once, with its smallest label; without usable
labels every score is 0.5; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.llm.pieces import blocks, text_array
from featlab.llm.shared import small_batches, text_or_empty, tidy, without

SAMPLE_DOCS = 6000
SAMPLE_LINES = 400
BLOCK_BYTES = 1 << 20
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "stop": b".", "comma": b",;:", "call": b"!?", "bar": b"|", "odd": b"#$%&*+=<>@^_~`\\{}[]", "quote": b"\"'()-/", "space": b" \t\r"}
FEATURES = ["empty", "size", "short", "upper", "digit", "stop", "comma", "call", "bar", "odd", "quote", "high", "space", "word", "shout", "marks",
            "distinct", "spread", "twins", "again", "ended", "brief"]


def line_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of texts: (features of every line, its length in bytes, lines of each text)."""
    for _, block in blocks(texts, BLOCK_BYTES):
        parts = pc.split_pattern(block, "\n")
        lines = parts.flatten()
        counts = np.diff(np.asarray(parts.offsets).astype(np.int64))
        n = len(lines)
        off = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + n + 1]
        data = np.frombuffer(lines.buffers()[2] or b"\0", np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        size = np.diff(off).astype(np.float64)

        def share(mask: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
            return sums[off[1:]] - sums[off[:-1]]
        table = np.zeros(256, np.uint8)
        for k, letters in enumerate(_CLASSES.values(), 1):
            table[np.frombuffer(letters, np.uint8)] = k
        kind = table[data]
        seen = {name: share(kind == k) for k, name in enumerate(_CLASSES, 1)}
        high = share(data >= 128)
        words = pc.ascii_split_whitespace(lines)
        coded = pc.dictionary_encode(words.flatten())
        real = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
        codes = np.asarray(coded.indices, np.int64)
        real = real[codes] if len(codes) else np.zeros(0, bool)
        woff = np.asarray(words.offsets).astype(np.int64)
        line = np.repeat(np.arange(n), np.diff(woff))[real]
        codes = codes[real]
        n_words = np.bincount(line, minlength=n).astype(np.float64)
        pairs = np.unique(line * np.int64(len(coded.dictionary) + 1) + codes)
        distinct = np.bincount(pairs // (len(coded.dictionary) + 1), minlength=n).astype(np.float64)
        twin = (line[1:] == line[:-1]) & (codes[1:] == codes[:-1])
        twins = np.bincount(line[1:][twin], minlength=n)
        # lines of three words or more that occur again in their text
        doc = np.repeat(np.arange(len(counts)), counts)
        same = np.asarray(pc.dictionary_encode(lines).indices, np.int64) + doc * np.int64(n + 1)
        _, inverse, times = np.unique(same, return_inverse=True, return_counts=True)
        again = (times[inverse] > 1) & (n_words >= 3)
        last = data[np.maximum(off[1:] - 1, 0)] if len(data) else np.zeros(n, np.uint8)

        some = np.maximum(size, 1)
        letters = np.maximum(seen["upper"] + seen["lower"] + high / 2, 1)
        w = np.maximum(n_words, 1)
        x = np.stack([
            size == 0, np.log1p(size) / 5, size < 40, seen["upper"] / letters, seen["digit"] / some * 5, np.minimum(seen["stop"] / w, 1) * 3,
            np.minimum(seen["comma"] / w, 1) * 3, np.minimum(seen["call"] / w, 2), np.minimum(seen["bar"] / w, 1), np.minimum(seen["odd"] / w, 3),
            np.minimum(seen["quote"] / w, 2), high / some * 2, seen["space"] / some * 3, np.minimum((size - seen["space"]) / w, 20) / 6,
            (seen["upper"] > 0.6 * letters) & (size > 0), (seen["odd"] + seen["bar"] + seen["call"]) > 0.3 * w,
            distinct / w, np.log1p(distinct) / np.log1p(w), twins / w, again, np.isin(last, np.frombuffer(b".!?:\"", np.uint8)) & (size > 0),
            n_words < 3], axis=1).astype(np.float64)
        yield x, size, counts


def with_neighbours(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and after it in its text, edge flags and a constant."""
    n, f = x.shape
    first = np.zeros(n, bool)
    ends = np.cumsum(counts)
    first[ends - counts] = True
    last = np.zeros(n, bool)
    last[ends - 1] = True
    out = np.zeros((n, 3 * f + 3))
    out[:, :f] = x
    out[1:, f:2 * f] = x[:-1]
    out[first, f:2 * f] = 0
    out[:-1, 2 * f:3 * f] = x[1:]
    out[last, 2 * f:3 * f] = 0
    out[:, 3 * f], out[:, 3 * f + 1], out[:, 3 * f + 2] = first, last, 1
    return out


@dataclass
class Model:
    weights: np.ndarray      # emission score of "good" against "bad"
    transitions: np.ndarray  # 2 x 2, score of (label, next label)
    centre: np.ndarray
    scale: np.ndarray

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(emission: np.ndarray, counts: np.ndarray, t: np.ndarray, pairs: bool = False):
    """Marginal P(good) of every line; with ``pairs`` also the expected
    transition counts and the log partition sum. Documents run in parallel,
    ordered by length, so the loop is over line numbers only."""
    order = np.argsort(-counts, kind="stable")
    lens = counts[order]
    starts = (np.cumsum(counts) - counts)[order]
    steps = int(lens[0]) if len(lens) else 0
    live = np.searchsorted(-lens, -np.arange(1, steps + 1), side="right")  # documents with more than k lines
    alpha = np.zeros((len(emission), 2))
    score = np.stack([np.zeros(len(emission)), emission], axis=1)
    for k in range(steps):
        at = starts[:live[k]] + k
        alpha[at] = score[at] if k == 0 else score[at] + _log_sum(alpha[at - 1][:, :, None] + t[None], 1)
    beta = np.zeros_like(alpha)
    for k in range(steps - 2, -1, -1):
        at = starts[:live[k + 1]] + k
        beta[at] = _log_sum(t[None] + (score[at + 1] + beta[at + 1])[:, None, :], 2)
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    if not pairs:
        return good, None, None
    total = _log_sum(alpha[starts + lens - 1], 1)
    inner = np.ones(len(emission), bool)
    inner[starts + lens - 1] = False
    i = np.flatnonzero(inner)
    doc_total = np.empty(len(emission))
    doc_total[:] = np.repeat(total[np.argsort(order, kind="stable")], counts)
    joint = alpha[i][:, :, None] + t[None] + (score[i + 1] + beta[i + 1])[:, None, :] - doc_total[i][:, None, None]
    return good, np.exp(joint).sum(axis=0), total.sum()


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 250, ridge: float = 2e-4) -> Model:
    """Maximum conditional likelihood by Adam on all lines; ``labels`` per document."""
    centre, scale = x.mean(axis=0), x.std(axis=0)
    centre[scale < 1e-9], scale[scale < 1e-9] = 0, 1
    z = (x - centre) / scale
    y = np.repeat(labels, counts).astype(np.float64)
    inner = np.ones(len(y), bool)
    inner[np.cumsum(counts) - 1] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[i].astype(int), y[i + 1].astype(int)), 1)
    w, t = np.zeros(z.shape[1]), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    for k in range(1, rounds + 1):
        good, pairs, _ = forward_backward(z @ w, counts, t, pairs=True)
        grads = ((y - good) @ z / len(y) - ridge * w, (seen - pairs) / len(y) - ridge * t)
        for j, (g, p) in enumerate(zip(grads, (w, t))):
            m, v = moments[2 * j], moments[2 * j + 1]
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p += 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return Model(w, t, centre, scale)


def score_texts(texts: pa.Array, model: Model | None) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, per text."""
    out = [np.zeros(0)]
    for x, size, counts in line_features(texts):
        if model is None:
            out.append(np.full(len(counts), 0.5))
            continue
        good, _, _ = forward_backward(model.emissions(with_neighbours(x, counts)), counts, model.transitions)
        starts = np.cumsum(counts) - counts
        weight = size + 1
        out.append(np.clip(np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts), 0, 1))
    return np.concatenate(out)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Model | None:
    """Model from the labelled documents outside the held-out fifth; None without two classes."""
    small_batches(docs.sparkSession)
    picked = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "quality") \
        .filter(~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")) \
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .join(F.broadcast(picked), "doc_id").select("quality", "text")  # at most sample_docs rows of 12 bytes

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, quality = 0, b.column(0).to_pylist()
            for x, _, counts in line_features(text_array(b.column(1))):
                ends = np.cumsum(counts)
                for k, (e, c) in enumerate(zip(ends.tolist(), counts.tolist())):
                    if c <= sample_lines:
                        yield pa.RecordBatch.from_pydict({"quality": pa.array([quality[at + k]], pa.int32()), "lines": pa.array([c], pa.int32()), "x": [x[e - c:e].reshape(-1)]})
                at += len(counts)
    found = rows.mapInArrow(tidy(features), "quality int, lines int, x array<double>").toPandas()
    if found["quality"].nunique() < 2:
        return None
    # the order rows arrive in must not matter
    found = found.assign(k=[float(np.sum(v)) for v in found["x"]]).sort_values(["lines", "k", "quality"], kind="stable")
    counts = found["lines"].to_numpy(np.int64)
    x = np.concatenate(found["x"].to_list()).reshape(-1, len(FEATURES))
    return fit(with_neighbours(x, counts), counts, found["quality"].to_numpy())


def classify(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, with ``text_sha256`` if ``hashed``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score_texts(text_array(b.column(1)), model), pa.float64()), *b.columns[2:]], ["doc_id", "score", *extra])
    text, extra = text_or_empty(text_col), ["text_sha256"] if hashed else []
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *[F.sha2(text, 256).alias(c) for c in extra]) \
        .mapInArrow(tidy(run), "doc_id long, score double" + "".join(f", {c} string" for c in extra))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *extra)


def quality_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled part and score all of ``docs``."""
    return classify(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows the classifier rejects."""
    rejected = classify(docs, train(docs, labels), hashed=True).filter("predicted = 0 and doc_id is not null").select("doc_id", "text_sha256").distinct()
    return without(docs, "doc_id", rejected, "quality-rejected", F.sha2(text_or_empty(), 256))
