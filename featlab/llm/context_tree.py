"""Operator 6, LM scoring by context-tree weighting over binary-decomposed bytes.

The model text of a document is its text with A-Z lower-cased, in UTF-8, closed
by the byte 0xFF (which UTF-8 never holds), and preceded by 0xFF bytes as
context. Every byte is eight binary decisions; each of the 255 decisions (a
prefix of the byte's bits) has a context tree of its own over the preceding
``DEPTH`` bytes. A node holds how often the next bit was 0 and 1 and weighs its
Krichevsky-Trofimov estimate against the product of its children:

    P(s) = KT(s) / 2 + product over children P(c) / 2,   P = KT at full depth

After training, a bit has the probability ``w KT + (1 - w) p(child)`` at every
node with ``w = KT(s) / (2 P(s))``, mixed from the deepest node to the root.

A context is a node of its own from its first occurrence on, at every corpus
size, so the number of nodes grows with the contexts the corpus holds. (With a
``NODE_SHARE`` above 0, contexts below that share of the training bytes would
share one pooled child of their parent; nothing but a test sets it.)

Job: (context, byte) counts per task, summed by Spark, dealt by the three nearest
context bytes; each task builds whole subtrees of depth >= 3 bottom-up (one sort,
then run sums, as dropping the farthest byte keeps the order); their roots are
summed into trees of depth 1 and 2, dealt by the nearest byte; at last 255 root
rows. Nodes store the probability with everything above factored out (``p = a +
r * p(below)``), so no layer waits for another. They are written as flat files
in the shared folder: nodes of depth 3 and more in parts by the three nearest
context bytes, the few above them (at most 65,793 contexts) in parts of their own.

Scoring brings the questions to the nodes, as no task could hold them all. Every
task maps the logarithms of the ``FREQUENT`` most frequent (context, byte) codes
of the corpus, and answers those itself (a bounded table, whatever the corpus).
The others of a block of texts travel, as sorted differences with the documents
they occur in, to the part that holds their nodes; a task there opens one part
at a time, answers the distinct codes of many blocks at once and emits sums per
document, which Spark adds up. Words are looked up in the same way. A part asked
by many blocks is shared by ``SALT`` tasks; no answer travels back per code.

Also counted over all training documents: the unigram base score of the words.

Defined results: NULL and empty text are the end alone; NULL ids are scored and
belong to the training part; repeated rows are scored, and learned from, as
often as they occur; an empty table gives an empty result, and without training
documents all probabilities are 1/2 per bit; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.llm.pieces import blocks, text_array
from featlab.llm.shared import remembered, shared_folder, small_batches, task_count, text_or_empty, tidy, written
from featlab.llm.store import get_array, put

DEPTH = 5
#: A context is a node if it occurs and has this share of the training bytes.
NODE_SHARE = 0.0
BLOCK_BYTES = 2 << 20
#: Rows a task sums or builds a tree from at a time, and questions it answers at once.
HELD = 1_500_000
ASKED = 500_000
#: Tasks that share the questions to one part.
SALT = 4
#: Codes, and words, whose answers every task has at hand (16 bytes each).
FREQUENT = 1 << 20
END = 0xFF


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2: Stirling's series after a shift by eight."""
    shift = np.ones_like(x)
    for k in range(8):
        shift *= np.where(x < 1e6, x + k, 1)
    z = np.where(x < 1e6, x + 8, x)
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7)
    return series - np.log(shift)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the KT block probability of n0 zeros and n1 ones."""
    a, b = np.asarray(n0, np.float64), np.asarray(n1, np.float64)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - math.log(math.pi)


def block_bytes(block: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Model bytes of all texts back to back, each behind DEPTH end bytes and
    closed by one, and the place where each text's bytes start."""
    texts = pc.ascii_lower(block)
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    lens = np.diff(off)
    starts = np.cumsum(lens + DEPTH + 1) - lens - 1
    out = np.full(len(data) + n * (DEPTH + 1), END, np.uint8)
    out[np.arange(len(data)) + np.repeat(starts - (off[:-1] - off[0]), lens)] = data
    return out, starts


def block_codes(block: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code of every model byte, number of them per text). A code is the byte
    followed by its context, nearest first, most significant byte first."""
    data, starts = block_bytes(block)
    ends = np.append(starts[1:] - DEPTH, len(data))
    padded = np.concatenate([np.full(7, END, np.uint8), data])
    codes = np.ndarray((len(data),), "<u8", buffer=padded, strides=(1,)) >> np.uint64(8 * (7 - DEPTH))
    counted = np.ones(len(data), bool)
    counted[(starts[:, None] - 1 - np.arange(DEPTH)).reshape(-1)] = False
    return codes[counted], ends - starts


def bit_nodes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node keys, bits), 8 columns: key = 1-prefixed bits so far, then the context bytes."""
    byte, context = codes >> np.uint64(8 * DEPTH), codes & np.uint64((1 << 8 * DEPTH) - 1)
    j = np.arange(8, dtype=np.uint64)
    prefix = (np.uint64(1) << j) | (byte[:, None] >> (np.uint64(8) - j))
    return prefix << np.uint64(8 * DEPTH) | context[:, None], (byte[:, None] >> (np.uint64(7) - j)) & np.uint64(1)


class Level:
    """Nodes of one depth, ascending keys: counts, log P, and what children took."""

    def __init__(self, key, n0, n1, child_log=None, m0=None, m1=None):
        self.key, self.n0, self.n1 = key, n0, n1
        zero = np.zeros(len(key))
        self.child_log, self.m0, self.m1 = (zero if child_log is None else child_log), (zero if m0 is None else m0), (zero if m1 is None else m1)

    def weigh(self, leaf: bool, least: float) -> None:
        own = log_kt(self.n0, self.n1)
        r0, r1 = self.n0 - self.m0, self.n1 - self.m1
        if leaf:
            self.log_p, self.w = own, np.ones(len(own))
        else:
            below = self.child_log + log_kt(r0, r1)
            self.log_p = np.logaddexp(own, below) - math.log(2)
            self.w = np.exp(np.minimum(own - self.log_p - math.log(2), 0))
        self.kt = (self.n1 + 0.5) / (self.n0 + self.n1 + 1)
        self.rest = (r1 + 0.5) / (r0 + r1 + 1)       # the pooled child
        self.node = self.n0 + self.n1 >= least

    def parents(self) -> Level:
        """The next shorter contexts, with sums over these nodes."""
        up = self.key >> np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]])) if len(up) else np.zeros(0, np.int64)
        total = (lambda v: np.add.reduceat(v, first)) if len(up) else (lambda v: v)
        return Level(up[first], total(self.n0), total(self.n1), *(total(np.where(self.node, v, 0.0)) for v in (self.log_p, self.n0, self.n1)))


def descend(levels: list[Level]) -> list[tuple[np.ndarray, ...]]:
    """For levels from shallow to deep: (keys, a, r, stop) of their nodes, so that
    p = a + r * p(below) from the first level on, and ``stop`` if no deeper node fits."""
    out = []
    a, r, keys = None, None, None
    for level in levels:
        if keys is None:
            a0, r0 = np.zeros(len(level.key)), np.ones(len(level.key))
            ok = level.node
        else:
            at = np.searchsorted(keys, level.key >> np.uint64(8))
            at = np.minimum(at, max(len(keys) - 1, 0))
            ok = level.node & (keys[at] == level.key >> np.uint64(8)) if len(keys) else np.zeros(len(level.key), bool)
            a0, r0 = (a[at], r[at]) if len(keys) else (np.zeros(len(level.key)), np.ones(len(level.key)))
        keys, w, kt, rest, a0, r0 = level.key[ok], level.w[ok], level.kt[ok], level.rest[ok], a0[ok], r0[ok]
        a, r = a0 + r0 * w * kt, r0 * (1 - w)
        out.append((keys, a, r, a + r * rest))
    return out


def build(key: np.ndarray, n0: np.ndarray, n1: np.ndarray, deepest: int, top: int, least: float, sums: tuple = ()) -> tuple[list, Level]:
    """Bottom-up from ``deepest`` to ``top``; (nodes by level from top on, weighed top level)."""
    levels = [Level(key, n0, n1, *sums)]
    for d in range(deepest, top - 1, -1):
        levels[-1].weigh(d == DEPTH, least)
        if d > top:
            levels.append(levels[-1].parents())
    levels.reverse()
    return descend(levels), levels[0]


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of ``values`` per distinct key, keys ascending."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return (keys[first], *((np.add.reduceat(v[order], first) if len(keys) else v) for v in values))


def tagged(key: np.ndarray, depth: int) -> np.ndarray:
    return key | np.uint64(depth << 56)


class Table:
    """Rows by 64-bit key in flat files of the shared folder. Parts are ranges of ``route(key)``, each sorted by key."""

    def __init__(self, folder: str, parts: list[tuple[str, int]], columns: list[str], route=lambda keys: keys):
        # parts: (name, first route), ascending
        self.first, self.route = np.asarray([k for _, k in parts], np.int64), route
        self.keys = [get_array(folder, f"{name}.key", "<i8") for name, _ in parts]
        self.columns = {c: [get_array(folder, f"{name}.{c}", "<f8") for name, _ in parts] for c in columns}

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """(is there a row, its columns) for ``keys``, repeats allowed."""
        hit = np.zeros(len(keys), bool)
        out = {c: np.zeros(len(keys)) for c in self.columns}
        if len(keys) and len(self.first):
            part_of = np.maximum(np.searchsorted(self.first, self.route(keys), side="right") - 1, 0)
            for k in np.unique(part_of).tolist():
                at = np.flatnonzero(part_of == k) if len(self.first) > 1 else slice(None)
                part, want = self.keys[k], keys[at]
                e = np.minimum(np.searchsorted(part, want), len(part) - 1)
                hit[at] = part[e] == want
                for c, v in self.columns.items():
                    out[c][at] = v[k][e]
        return hit, out


def nearest_three(tagged_keys: np.ndarray) -> np.ndarray:
    """The three nearest context bytes of node keys of depth 3 and more."""
    depth = tagged_keys >> 56
    return tagged_keys >> 8 * (depth - 3) & 0xFFFFFF


class Nodes:
    """The nodes in the given parts: names with ``d`` are by nearest context, those with ``t`` hold the depths below 3."""

    def __init__(self, folder: str, parts: list[tuple[str, int]], columns: list[str]):
        self.deep = Table(folder, [p for p in parts if p[0].startswith("d")], columns, nearest_three)
        self.top = Table(folder, [p for p in parts if p[0].startswith("t")], columns)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """As ``Table.find``, for ascending keys (the depth is their highest byte)."""
        cut = int(np.searchsorted(keys, 3 << 56))
        (h0, c0), (h1, c1) = self.top.find(keys[:cut]), self.deep.find(keys[cut:])
        return np.concatenate([h0, h1]), {c: np.concatenate([c0[c], c1[c]]) for c in c0}


def write_table(rows: DataFrame, key: str, columns: list[str], folder: str, letter: str = "", route: Column | None = None) -> list[tuple[str, int]]:
    """Parts of ``Table``: ``rows`` range-partitioned by ``route`` (else the key) and sorted by ``key``; one small row per part reaches the driver."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = f"{letter}{task.partitionId():06d}", str(task.taskAttemptId())
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        keys = np.concatenate([b.column(0).to_numpy() for b in held]).astype("<i8")
        put(folder, f"{part}.key", [keys.tobytes()], attempt)
        for k, c in enumerate(columns, 2):
            put(folder, f"{part}.{c}", [b.column(k).to_numpy(zero_copy_only=False).astype("<f8").tobytes() for b in held], attempt)
        yield pa.RecordBatch.from_pydict({"part": [part], "first": [min(pc.min(b.column(1)).as_py() for b in held)]})
    dealt = rows.select(key, (F.col(key) if route is None else route).alias("_route"), *columns) \
        .repartitionByRange(task_count(rows.sparkSession), "_route").sortWithinPartitions(key)
    parts = sorted((r["first"], r["part"]) for r in dealt.mapInArrow(tidy(write), "part string, first long").collect())
    return [(p, k) for k, p in parts]


def open_table(folder: str, parts: tuple, columns: tuple) -> Table | Nodes:
    """All parts at once (for a look at a whole small model; tasks open one part)."""
    return (Nodes if any(name[0] in "dt" for name, _ in parts) else Table)(folder, list(parts), list(columns))


def probability_of_one(nodes: Table, keys: np.ndarray) -> np.ndarray:
    """P(next bit is 1) for distinct ascending node keys with DEPTH context bytes."""
    def look(depth: int, at: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        return nodes.find((tagged(keys[at] >> np.uint64(8 * (DEPTH - depth)), depth)).view(np.int64))

    p = np.full(len(keys), 0.5)
    below = np.zeros(len(keys), bool)  # a node of a deeper layer has given p
    for layer in ((5, 4, 3), (2, 1), (0,)):
        todo = np.arange(len(keys))
        for depth in (d for d in layer if d <= DEPTH):
            hit, v = look(depth, todo)
            at = todo[hit]
            p[at] = np.where(below[at], v["a"][hit] + v["r"][hit] * p[at], v["stop"][hit])
            below[at] = True
            todo = todo[~hit]
    return p


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def block_words(block: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes of the distinct words, number of the word at every place, words of each text)."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(block))
    coded = pc.dictionary_encode(parts.flatten())
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)
    codes = np.asarray(coded.indices, np.int64)
    real = np.fromiter(map(bool, words), bool, len(words))[codes] if len(codes) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(real)])[np.asarray(parts.offsets).astype(np.int64) - parts.offsets[0].as_py()]
    return hashes, codes[real], np.diff(ends)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how often each (kind, key) occurs; kind 0 are byte codes, 1 words."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {0: [], 1: []}

    def out(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])

    def reduce(kind: int) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*held[kind]))
        return summed(keys, n)

    for b in batches:
        for _, block in blocks(text_array(b.column(0)), BLOCK_BYTES):
            codes, _ = block_codes(block)
            keys, n = np.unique(codes, return_counts=True)
            held[0].append((keys.view(np.int64), n))
            hashes, words, _ = block_words(block)
            n = np.bincount(words, minlength=len(hashes))
            held[1].append((hashes[n > 0], n[n > 0]))
            for kind, got in held.items():
                if sum(len(k) for k, _ in got) > HELD:
                    keys, n = reduce(kind)
                    held[kind] = [(keys, n)]
                    if len(keys) > HELD // 2:
                        yield out(kind, keys, n)
                        held[kind] = []
    for kind in held:
        if held[kind]:
            yield out(kind, *reduce(kind))


_SUMS = ["n0", "n1", "child_log", "m0", "m1"]
_NODE_ROWS = "key long, a double, r double, stop double, up long, " + ", ".join(f"{c} double" for c in _SUMS)


def _node_rows(nodes: list, top: Level, depth: int) -> Iterator[pa.RecordBatch]:
    """Rows of the nodes (key, a, r, stop) and of the sums for the level above (up, ...)."""
    names = ["key", "a", "r", "stop", "up", *_SUMS]

    def rows(values: list, first: int) -> pa.RecordBatch:
        n = len(values[0])
        columns = [pa.nulls(n, pa.int64() if c in ("key", "up") else pa.float64()) for c in names]
        columns[first:first + len(values)] = [pa.array(v) for v in values]
        return pa.RecordBatch.from_arrays(columns, names)
    for d, (keys, a, r, stop) in enumerate(nodes, depth):
        yield rows([tagged(keys, d).view(np.int64), a, r, stop], 0)
    if depth:
        up = top.parents()
        yield rows([up.key.view(np.int64), *(np.asarray(v, np.float64) for v in (up.n0, up.n1, up.child_log, up.m0, up.m1))], 4)


def _deep(least: float):
    """Codes sorted by their three nearest context bytes: whole subtrees of depth >= 3."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, size = [], [], 0

        def solve(c: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
            keys, bits = bit_nodes(c.view(np.uint64))
            n1 = (m[:, None] * bits.astype(np.float64)).reshape(-1)
            n0 = np.repeat(m, 8) - n1
            yield from _node_rows(*build(*summed(keys.reshape(-1), n0, n1), DEPTH, 3, least), 3)

        for b in batches:
            if not b.num_rows:
                continue
            codes.append(b.column(0).to_numpy())
            n.append(b.column(1).to_numpy().astype(np.float64))
            size += b.num_rows
            if size >= HELD // 8:
                c, m = np.concatenate(codes), np.concatenate(n)
                near = c >> (8 * DEPTH - 24) & 0xFFFFFF
                cut = int(np.argmax(near == near[-1]))
                if cut:
                    yield from solve(c[:cut], m[:cut])
                    codes, n, size = [c[cut:]], [m[cut:]], len(c) - cut
                else:
                    codes, n = [c], [m]
        if size:
            yield from solve(np.concatenate(codes), np.concatenate(n))
    return run


def _upper(deepest: int, top: int, least: float):
    """Sums of one level (key, then _SUMS) to the layer ``deepest`` .. ``top``; the keys of one top node are in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            key, *sums = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(6))
            order = np.argsort(key.view(np.uint64), kind="stable")
            key, sums = key[order].view(np.uint64), [s[order] for s in sums]
            yield from _node_rows(*build(key, sums[0], sums[1], deepest, top, least, tuple(sums[2:])), top)
    return run


def _sums(rows: DataFrame, name: str) -> DataFrame:
    return rows.filter("up is not null").groupBy("up").agg(*[F.sum(c).alias(c) for c in _SUMS]).select(F.col("up").alias("key"), *_SUMS)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Tables and totals of the model from the rows that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    learned = docs.filter(~is_held_out(id_col)).select(text_or_empty(text_col).alias("text"))
    counts = written(learned.mapInArrow(tidy(_count), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    totals = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()}
    n_docs = learned.count()
    n_bytes = totals[0]["n"] if 0 in totals else 0
    least = max(1.0, math.ceil(n_bytes * NODE_SHARE))
    n = task_count(spark)

    near = F.shiftright("key", 8 * DEPTH - 24).bitwiseAND(F.lit(0xFFFFFF))
    codes = counts.filter("kind = 0").select("key", "n", near.alias("near")).repartition(n, "near").sortWithinPartitions("near").select("key", "n")
    deep = written(codes.mapInArrow(tidy(_deep(least)), _NODE_ROWS), "lm-deep")
    mid_sums = _sums(deep, "lm-mid").withColumn("c1", F.shiftright("key", 8).bitwiseAND(F.lit(255)))
    mid = written(mid_sums.repartition(n, "c1").select("key", *_SUMS).mapInArrow(tidy(_upper(2, 1, least)), _NODE_ROWS), "lm-mid")
    root = written(_sums(mid, "lm-root").coalesce(1).mapInArrow(tidy(_upper(0, 0, least)), _NODE_ROWS), "lm-root")  # 255 rows at most
    folder = shared_folder(spark, "lm-model")
    depth = F.shiftright("key", 56)
    near_node = F.expr("shiftright(key, cast(8 * (shiftright(key, 56) - 3) as int)) & 16777215")
    nodes = deep.filter("key is not null")
    parts = write_table(nodes.filter(depth >= 3), "key", ["a", "r", "stop"], folder, "d", near_node)
    parts += write_table(nodes.filter(depth < 3).unionAll(mid.unionAll(root).filter("key is not null")), "key", ["a", "r", "stop"], folder, "t")
    node_table = folder, parts
    word_table = folder, write_table(counts.filter("kind = 1").select("key", F.col("n").cast("double").alias("n")), "key", ["n"], folder, "w")
    words = totals.get(1)
    model = {"nodes": node_table, "words": word_table, "n_docs": n_docs, "least": least,
             "tokens": (words["n"] if words else 0) + n_docs, "distinct": (words["distinct"] if words else 0) + (n_docs > 0)}
    asked = _most_frequent(counts, 0).select(F.expr(f"((key & {(1 << 8 * DEPTH) - 1}) << 8) | shiftrightunsigned(key, {8 * DEPTH})").alias("q"))
    logs = written(_dealt(asked, node_table[1]).mapInArrow(tidy(_logs(model)), "q long, log double"), "lm-frequent")
    model["logs"] = folder, write_table(logs, "q", ["log"], folder, "c")
    model["common"] = folder, write_table(_most_frequent(counts, 1).select("key", F.col("n").cast("double").alias("n")), "key", ["n"], folder, "v")
    return model


def _most_frequent(counts: DataFrame, kind: int) -> DataFrame:
    """The keys whose count is above the least step (an eighth of a power of two) that keeps them to ``FREQUENT`` at most."""
    some = counts.filter(F.col("kind") == kind)
    step = F.floor(F.log2("n") * 8)
    taken, above = 0, 1 << 30
    for r in some.groupBy(step.alias("step")).agg(F.count("*").alias("keys")).orderBy(F.desc("step")).collect():  # 512 rows at most
        taken += r["keys"]
        if taken > FREQUENT:
            break
        above = r["step"]
    return some.filter(step >= above).select("key", "n")


def _dealt(asked: DataFrame, node_parts: list[tuple[str, int]]) -> DataFrame:
    """``part, q``: questions with the part that holds their nodes, sorted by both."""
    first = np.asarray([k for name, k in node_parts if name.startswith("d")], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = b.column(0).to_numpy() >> 8 * DEPTH + 8 - 24
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(np.searchsorted(first, near, side="right") - 1, 0).astype(np.int32)), b.column(0)], ["part", "q"])
    return asked.mapInArrow(run, "part int, q long").repartition(task_count(asked.sparkSession), "part").sortWithinPartitions("part", "q")


def _logs(model: dict):
    """Rows of ``_dealt`` to the logarithms of their probabilities, one part open at a time."""
    folder, deep, top = _split(model["nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes = None, None
        for b in batches:
            parts, asked = b.column(0).to_numpy(), b.column(1).to_numpy()
            for part in np.unique(parts).tolist():
                if part != now:
                    now, nodes = part, Nodes(folder, [deep[part], *top], ["a", "r", "stop"])
                some = asked[parts == part]
                for k in range(0, len(some), ASKED):
                    yield pa.RecordBatch.from_arrays([pa.array(some[k:k + ASKED]), pa.array(answers(nodes, some[k:k + ASKED].view(np.uint64)))], ["q", "log"])
    return run


def _split(table: tuple[str, list[tuple[str, int]]]) -> tuple[str, list, list]:
    """(folder, parts of deep nodes, parts of the others)."""
    folder, parts = table
    return folder, [p for p in parts if p[0].startswith("d")], [p for p in parts if p[0].startswith("t")]


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences, byte plane after byte plane (the upper planes are zeros to a compressor)."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


_CONTEXT = np.uint64((1 << 8 * DEPTH) - 1)


def questions(codes: np.ndarray) -> np.ndarray:
    """Codes with the context in front, so that they sort by nearest context."""
    return (codes & _CONTEXT) << np.uint64(8) | codes >> np.uint64(8 * DEPTH)


def answers(nodes: Nodes, asked: np.ndarray) -> np.ndarray:
    """log10 of the probability of each (distinct) question's byte."""
    codes = (asked & np.uint64(255)) << np.uint64(8 * DEPTH) | asked >> np.uint64(8)
    keys, bits = bit_nodes(codes)
    distinct, which = np.unique(keys.reshape(-1), return_inverse=True)
    one = probability_of_one(nodes, distinct)[which].reshape(-1, 8)
    return np.log10(np.where(bits == 1, one, 1 - one)).sum(axis=1)


def unsigned(hashes: np.ndarray) -> np.ndarray:
    """Signed 64-bit keys in the same order as unsigned ones."""
    return hashes.view(np.uint64) ^ np.uint64(1 << 63)


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane after byte plane."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


@remembered(4)
def at_hand(folder: str, parts: tuple, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(ascending keys, values) of a bounded table."""
    keys = [get_array(folder, f"{name}.key", "<i8") for name, _ in parts]
    return np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0), *(get_array(folder, f"{name}.{column}", "<f8") for name, _ in parts)])


def look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it there, its value or 0)."""
    if not len(table[0]):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    hit = table[0][at] == keys
    return hit, np.where(hit, table[1][at], 0.0)


#: Rows that travel: questions to nodes (kind 0) and words (1), with how often and in which
#: documents of the block each occurs, and what a block knows of its documents itself (2).
_TRAVEL = "block long, kind int, part int, keys binary, times binary, docs binary"
_PARTIAL = "block long, doc int, doc_id long, n_tokens long, n_bytes long, n_known long, base_score double, score double"


def _grouped(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys ascending, how often each, documents in the order of the keys)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys))), docs[order]


def _ask(model: dict, floor: float):
    """Per block of texts: sums over what is at hand, and questions for the rest."""
    node_first = np.asarray([k for _, k in _split(model["nodes"])[1]], np.int64)
    word_first = np.asarray([k for _, k in model["words"][1]], np.int64)
    unseen = math.log10(0.5 / floor)

    def rest(block: int, kind: int, keys: np.ndarray, times: np.ndarray, docs: np.ndarray, missing: np.ndarray, route: np.ndarray, first: np.ndarray) -> list[tuple]:
        """Rows of the keys that were not at hand; ``docs`` in the order of all keys."""
        docs = docs[np.repeat(missing, times)]
        keys, times, route = keys[missing], times[missing], route[missing]
        cuts = [0, *np.searchsorted(route, first[1:]).tolist(), len(keys)]
        ends = np.concatenate([[0], np.cumsum(times)])
        return [(block, kind, k, pack_sorted(keys[a:b]), planes(times[a:b]), planes(docs[ends[a]:ends[b]])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        logs, common = at_hand(*model["logs"], "log"), at_hand(*model["common"], "n")
        for b in batches:
            for at, texts in blocks(text_array(b.column(1)), BLOCK_BYTES):
                n = len(texts)
                codes, n_bytes = block_codes(texts)
                asked, times, docs = _grouped(questions(codes), np.repeat(np.arange(n, dtype=np.uint32), n_bytes))
                hit, value = look_up(logs, asked.view(np.int64))
                if not len(node_first):  # nothing was learned
                    hit, value = np.ones(len(asked), bool), np.full(len(asked), 8 * math.log10(0.5))
                score = np.bincount(docs, np.repeat(value, times), n)
                rows = rest(number, 0, asked, times, docs, ~hit, (asked >> np.uint64(8 * DEPTH + 8 - 24)).astype(np.int64), node_first) if not hit.all() else []

                hashes, place, per_text = block_words(texts)
                words, times, docs = _grouped(hashes[place], np.repeat(np.arange(n, dtype=np.uint32), per_text))
                hit, found = look_up(common, words)
                base = np.bincount(docs, np.repeat(np.where(hit, np.log10((found + 0.5) / floor), 0.0), times), n)
                known = np.bincount(docs, np.repeat(hit, times), n)
                if not len(word_first):
                    base, hit = base + unseen * per_text, np.ones(len(words), bool)
                if not hit.all():
                    rows += rest(number, 1, unsigned(words), times, docs, ~hit, words, word_first)
                ids = b.column(0).slice(at, n)
                own = [ids.is_valid().to_numpy(zero_copy_only=False).astype("<f8"), per_text.astype("<f8"), n_bytes.astype("<f8"), known.astype("<f8"), base, score]
                rows.append((number, 2, number % 9973, ids.fill_null(0).to_numpy().astype("<i8").tobytes(), np.stack(own).astype("<f8").tobytes(), b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                                 names=[f.split()[0] for f in _TRAVEL.split(", ")])
                number += 1
    return run


def _partial(block: int, docs: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    kinds = {f.split()[0]: pa.float64() if f.endswith("double") else pa.int64() for f in _PARTIAL.split(", ")[2:]}
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), block)), pa.array(docs.astype(np.int32)),
                                       *(pa.array(columns[c]).cast(t) if c in columns else pa.nulls(len(docs), t) for c, t in kinds.items())], names=["block", "doc", *kinds])


def _answer(model: dict, floor: float):
    """Questions sorted by kind and part to sums per document; one part is open at a time."""
    folder, deep, top = _split(model["nodes"])
    parts = model["words"][1]

    def solve(kind: int, part: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        distinct = np.unique(np.concatenate([h[1] for h in held]))
        if kind == 0:
            values = answers(Nodes(folder, [deep[part], *top], ["a", "r", "stop"]), distinct)
        else:
            hit, found = Table(folder, [parts[part]], ["n"]).find((distinct ^ np.uint64(1 << 63)).view(np.int64))
            n = np.where(hit, found["n"], 0.0)
            values = np.log10((n + 0.5) / floor)
        for block, keys, times, docs in held:
            at = np.searchsorted(distinct, keys)
            some, inverse = np.unique(docs, return_inverse=True)
            sums = np.bincount(inverse, np.repeat(values[at], times), len(some))
            if kind == 0:
                yield _partial(block, some, score=sums)
            else:
                yield _partial(block, some, base_score=sums, n_known=np.bincount(inverse, np.repeat(n[at] > 0, times), len(some)).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for b in batches:
            for block, kind, part, keys, times, docs in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 2:
                    ids = np.frombuffer(keys, "<i8")
                    valid, tokens, n_bytes, known, base, score = np.frombuffer(times, "<f8").reshape(6, -1)
                    yield _partial(block, np.arange(len(ids)), doc_id=pa.array(ids, mask=valid == 0), n_tokens=tokens.astype(np.int64), n_bytes=n_bytes.astype(np.int64),
                                   n_known=known.astype(np.int64), base_score=base, score=score)
                    continue
                if held and ((kind, part) != now or size >= ASKED):
                    yield from solve(*now, held)
                    held, size = [], 0
                now = kind, part
                held.append((block, unpack_sorted(keys), unplanes(times), unplanes(docs)))
                size += len(held[-1][3])
        if held:
            yield from solve(*now, held)
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    n_docs, tokens, floor = model["n_docs"], model["tokens"], model["tokens"] + 0.5 * (model["distinct"] + 1)
    model = {k: (v[0], tuple(v[1])) if isinstance(v, tuple) else v for k, v in model.items()}
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    asked = texts.mapInArrow(tidy(_ask(model, floor)), _TRAVEL)
    partial = asked.repartition(task_count(spark), "kind", "part", F.pmod(F.xxhash64("block"), F.lit(SALT))).sortWithinPartitions("kind", "part") \
        .mapInArrow(tidy(_answer(model, floor)), _PARTIAL)
    sums = partial.groupBy("block", "doc").agg(*[F.max(c).alias(c) for c in ("doc_id", "n_tokens", "n_bytes")], *[F.sum(c).alias(c) for c in ("n_known", "base_score", "score")])
    end = math.log10((n_docs + 0.5) / floor)
    return sums.select("doc_id", is_held_out().alias("held_out"), (F.col("n_tokens") + 1).alias("n_tokens"), (F.col("n_known") + F.lit(int(n_docs > 0))).alias("n_known"),
                       F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base_score") + F.lit(end)).alias("base_score"), "score", "n_bytes")


def score_all(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, train(docs, id_col, text_col), id_col, text_col)
