"""Topic models over a sparse document x term matrix: LSI and LDA.

The matrix is written once, in blocks of documents, as files of the shared
folder; terms are numbered by part (a hash of the term) and place in the part,
and the model's ``k`` numbers of the terms are one flat file per part. A round is
two steps:

1. a task opens one block after the other, picks the numbers of the block's own
   terms out of the part files, works through the block's documents and adds up
   its new sums per term (several blocks together, up to ``HELD_TERMS``);
2. the sums are shuffled by part, one task adds up a part and writes its new file.

Neither the matrix nor (block, term) rows are shuffled in a round, and only k x k
(LSI) or k (LDA) numbers reach the driver.

LSI is subspace iteration: block^T (block V), orthonormalised by the k x k Gram
matrix. LDA is variational Bayes over all documents in every round: per document
``E_STEPS`` updates of its topic weights, which start from those of the round
before, then the expected counts per topic and term; priors 1 / k.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featlab.session import ensure_checkpoint_dir, written_table
from featlab.sources.shared_files import drop, get_array, put

#: Terms of a part, sums that a task holds for several blocks.
PART_TERMS, HELD_TERMS = 1 << 18, 1 << 20
#: Updates of a document's topics in a round, and with the final topics.
E_STEPS, LAST_STEPS = 3, 10
#: Blocks of a task number their files below its attempt's number.
BLOCKS_A_TASK = 1 << 20


def digamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    r = 1 / (y * y)
    return np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r / 252)) - sum(1 / (x + i) for i in range(6))


def _attempt() -> str:
    return str(TaskContext.get().taskAttemptId())


# ---- the matrix ------------------------------------------------------------------------------
@dataclass
class Block:
    ids: pa.Array
    words: pa.Array
    sizes: np.ndarray     # entries of each document
    codes: np.ndarray     # word of each entry
    values: np.ndarray
    numbers: np.ndarray   # of the words: part << 32 | place
    df: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)


def _ipc(x: pa.Array) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, pa.schema([("x", x.type)])) as w:
        w.write_batch(pa.RecordBatch.from_arrays([x], names=["x"]))
    return out.getvalue().to_pybytes()


def _cut(held: list[pa.RecordBatch]) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """(file content, words, documents of each word) of some documents; equal words of a row are added up."""
    t = pa.Table.from_batches(held).combine_chunks()
    size = pc.fill_null(pc.list_value_length(t.column("terms")), 0).to_numpy().astype(np.int64)
    coded = t.column("terms").combine_chunks().flatten().dictionary_encode()
    code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    counted = t.column("values").null_count == len(t)
    value = None if counted else t.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)[code >= 0]
    words = coded.dictionary.cast(pa.string())
    row = np.repeat(np.arange(len(t)), size)[code >= 0]
    key = row * max(1, len(words)) + code[code >= 0]
    if counted:
        key, value = np.unique(key, return_counts=True)
    else:
        key, where = np.unique(key, return_inverse=True)
        value = np.bincount(where, value, len(key))
    row, code = np.divmod(key, max(1, len(words)))
    sizes, codes = np.bincount(row, minlength=len(t)).astype(np.int32), code.astype(np.int32)
    ids, texts = _ipc(t.column("id").combine_chunks()), _ipc(words)
    head = struct.pack("<6q", len(sizes), len(codes), counted, len(ids), len(texts), 0)
    return [head, sizes.tobytes(), codes.tobytes(), value.astype(np.int32 if counted else np.float64).tobytes(), ids, texts], words, np.bincount(codes, minlength=len(words))


def _open(folder: str, block: int) -> Block:
    raw = get_array(folder, f"block-{block}", np.uint8)
    n, m, counted, a, b, _ = struct.unpack("<6q", raw[:48].tobytes())
    at, out = 48, []
    for size in (4 * n, 4 * m, (4 if counted else 8) * m, a, b):
        out.append(raw[at:at + size])
        at += size
    ids, words = (pa.ipc.open_stream(x.tobytes()).read_all().column(0) for x in out[3:])
    known = get_array(folder, f"terms-{block}", np.int64)
    return Block(*[pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type) for x in (ids, words)], out[0].view(np.int32), out[1].view(np.int32),
                 np.frombuffer(out[2].tobytes(), np.int32 if counted else np.float64).astype(float), known[::2], known[1::2])


def write_blocks(rows: DataFrame, folder: str, entries: int) -> DataFrame:
    """Writes the matrix of ``id, terms, values`` (one row per document; NULL values: each place counts 1) in blocks
    of about ``entries``; returns ``block, code, term, df`` of their distinct terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a repeated attempt writes files of its own: rows may reach it in another order
        number, count, held = TaskContext.get().taskAttemptId() * BLOCKS_A_TASK, 0, []

        def block() -> pa.RecordBatch:
            content, words, df = _cut(held)
            put(folder, f"block-{number}", content, _attempt())
            # a block without any term is listed too: code -1
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(words) + 1, number)), pa.array(np.arange(-1, len(words), dtype=np.int32)),
                                               pa.concat_arrays([pa.array([None], pa.string()), words]), pa.array(np.concatenate([[0], df]).astype(np.int64))], names=["block", "code", "term", "df"])
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < b.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + entries - count, "right")))
                held.append(b.slice(at, to - at))
                count += int(ends[to - 1] - before)
                at = to
                if count >= entries or at < b.num_rows:
                    yield block()
                    number, count, held = number + 1, 0, []
        if held:
            yield block()
    return rows.select("id", "terms", F.col("values").cast("array<double>").alias("values")).mapInArrow(run, "block long, code int, term string, df long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a sorted stream, one table per value of the first column."""
    held, now = [], None
    for b in batches:
        keys = b.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            if held and keys[i] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = keys[i]
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Matrix:
    """A written matrix: its folder, ``block`` rows, ``term, number, df`` rows, parts and tasks of a round."""
    folder: str
    blocks: DataFrame
    terms: DataFrame
    parts: int
    tasks: int
    k: int

    def per_block(self, run, schema: str) -> DataFrame:
        """``run`` over the numbers of the blocks, in tasks of several blocks."""
        return self.blocks.repartition(self.tasks, "block").mapInArrow(run, schema)


def matrix(found: list[DataFrame], folder: str, k: int, seed: int) -> Matrix:
    """Numbers the terms of written blocks (``write_blocks``) and writes the part files of ``start`` (k seeded numbers
    in [-1, 1) per term, the same at any partitioning) and the numbers of each block's terms."""
    spark = found[0].sparkSession
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rows = written_table(rows)
    blocks = written_table(rows.filter("code < 0").select("block"))
    counted = written_table(rows.filter("code >= 0").groupBy("term").agg(F.sum("df").alias("df")))
    parts = max(1, -(-counted.count() // PART_TERMS))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches):
            part, n = t.column("part")[0].as_py(), t.num_rows
            start = np.stack([t.column(f"v{j}").to_numpy() for j in range(k)], axis=1)
            put(f"{folder}/start", str(part), [start.tobytes()], _attempt())
            yield from pa.table({"term": t.column("term"), "number": pa.array((part << 32) + np.arange(n)), "df": t.column("df")}).to_batches(max_chunksize=50_000)
    seeded = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(j), "term"), F.lit(20_001)) / 10_000 - 1).alias(f"v{j}") for j in range(k)]
    terms = written_table(counted.select(F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"), "term", "df", *seeded).repartition(tasks, "part")
                          .sortWithinPartitions("part", "term").mapInArrow(number, "term string, number long, df long"))

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches):
            known = np.stack([t.column("number").to_numpy(), t.column("df").to_numpy()], axis=1)
            put(folder, f"terms-{t.column('block')[0].as_py()}", [known.tobytes()], _attempt())
        yield from ()
    rows.filter("code >= 0").select("block", "code", "term").join(terms, "term").select("block", "code", "number", "df").repartition(tasks, "block") \
        .sortWithinPartitions("block", "code").mapInArrow(note, "done int").write.format("noop").mode("overwrite").save()
    return Matrix(folder, blocks, terms, parts, tasks, k)


# ---- rounds ----------------------------------------------------------------------------------
def _pick(folder: str, state: str, numbers: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` numbers of each term, one part file open at a time."""
    out = np.empty((len(numbers), k))
    order = np.argsort(numbers)
    part = (numbers >> 32)[order]
    for p in np.unique(part).tolist():
        rows = order[np.searchsorted(part, p):np.searchsorted(part, p, "right")]
        out[rows] = get_array(f"{folder}/{state}", str(p), np.float64).reshape(-1, k)[numbers[rows] & 0xFFFFFFFF]
    return out


def _summed(numbers: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, where = np.unique(np.concatenate(numbers), return_inverse=True)
    each = np.concatenate(sums)
    return key, np.stack([np.bincount(where, each[:, j], len(key)) for j in range(each.shape[1])], axis=1)


def _round(m: Matrix, work, state: str, finish) -> np.ndarray:
    """Writes the part files of ``state``: ``finish`` of the sums per term that ``work(block number)`` returns as
    (numbers, n x k sums). Returns the sum over the parts of what ``finish`` returns beside a part's numbers."""
    folder, k = m.folder, m.k

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sums, held = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for p in np.unique(numbers[0] >> 32).tolist():
                i, j = np.searchsorted(numbers[0], [p << 32, (p + 1) << 32])
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([(numbers[0][i:j] & 0xFFFFFFFF).astype(np.int32).tobytes()], pa.binary()),
                                                  pa.array([sums[0][i:j].astype(np.float32).tobytes()], pa.binary())], names=["part", "places", "sums"])
        for b in batches:
            for block in b.column(0).to_pylist():
                n, s = work(block)
                if not len(n):
                    continue
                numbers.append(n)
                sums.append(s)
                held += len(n)
                if held > HELD_TERMS:
                    n, s = _summed(numbers, sums)
                    numbers, sums, held = [n], [s], len(n)
                    if held > HELD_TERMS // 2:
                        yield from out()
                        numbers, sums, held = [], [], 0
        if numbers:
            n, s = _summed(numbers, sums)
            numbers, sums = [n], [s]
            yield from out()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(part: int, total: np.ndarray) -> pa.RecordBatch:
            new, more = finish(total)
            put(f"{folder}/{state}", str(part), [new.tobytes()], _attempt())
            return pa.RecordBatch.from_pydict({"at": pa.array(range(more.size), pa.int32()), "v": more.reshape(-1)})
        now, total = None, None
        for b in batches:
            for part, places, sums in zip(*[c.to_pylist() for c in b.columns]):
                if part != now:
                    if now is not None:
                        yield done(now, total)
                    now, total = part, np.zeros((len(get_array(f"{folder}/start", str(part), np.float64)) // k, k))
                total[np.frombuffer(places, np.int32)] += np.frombuffer(sums, np.float32).reshape(-1, k)   # a row names a term once
        if now is not None:
            yield done(now, total)
    sent = m.per_block(add_up, "part int, places binary, sums binary").repartition(min(m.tasks, m.parts), "part").sortWithinPartitions("part")
    more = sent.mapInArrow(write, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()   # k or k x k rows
    out = np.zeros(max((r["at"] for r in more), default=-1) + 1)
    for r in more:
        out[r["at"]] = r["v"]
    return out


def _drop(folder: str, *states: str | None) -> None:
    """Of the files of the round before nothing is read again (of the start, the sizes are)."""
    for name in states:
        if name not in (None, "start"):
            drop(f"{folder}/{name}")


def _weights(b: Block, weight) -> np.ndarray:
    """Of the entries; a document without id has no part in the model."""
    w = weight(b)
    w[b.ids.is_null().to_numpy(zero_copy_only=False)[b.row]] = 0.0
    return w


def lsi(m: Matrix, weight, rounds: int):
    """Subspace iteration; returns a function from numbers to the n x k vectors of the terms."""
    folder, k = m.folder, m.k
    state, turn = "start", np.eye(k)
    for r in range(rounds):
        def work(block: int, state=state, turn=turn):
            b = _open(folder, block)
            w, row, codes = _weights(b, weight), b.row, b.codes
            v = _pick(folder, state, b.numbers, k) @ turn
            sums = [np.bincount(codes, w * np.bincount(row, w * v[codes, j], len(b.sizes))[row], len(b.numbers)) for j in range(k)]
            return b.numbers, np.stack(sums, axis=1)
        old, state = state, f"lsi{r}"
        gram = _round(m, work, state, lambda total: (total, total.T @ total))
        _drop(folder, old)
        g = gram.reshape(k, k) if gram.size else np.eye(k)
        values, vectors = np.linalg.eigh((g + g.T) / 2)
        turn = vectors / np.sqrt(np.maximum(values, 1e-300))
        turn[:, values <= values.max() * 1e-24] = 0.0  # fewer directions than k
    return lambda numbers: _pick(folder, state, numbers, k) @ turn


def _mixes(weight: np.ndarray, row: np.ndarray, codes: np.ndarray, likely: np.ndarray, gamma: np.ndarray, steps: int):
    """Variational updates of the documents' topic weights ``gamma``: (gamma, exp E[log theta], weight / norm of the entries)."""
    k = gamma.shape[1]
    for step in range(steps + 1):
        theta = np.exp(digamma(gamma) - digamma(gamma.sum(axis=1))[:, None])
        norm = sum(theta[row, j] * likely[codes, j] for j in range(k)) + 1e-100
        share = weight / norm
        if step < steps:
            gamma = 1 / k + theta * np.stack([np.bincount(row, share * likely[codes, j], len(gamma)) for j in range(k)], axis=1)
    return gamma, theta, share


def lda(m: Matrix, weight, rounds: int):
    """Variational Bayes; returns functions: from numbers to the topic mix of a document of that one term, and from
    (block number, block) to the topic mixes of its documents."""
    folder, k = m.folder, m.k

    def likely(numbers: np.ndarray, state: str, totals: np.ndarray | None) -> np.ndarray:
        """exp E[log beta] of the terms."""
        lam = _pick(folder, state, numbers, k)
        if totals is None:   # the start: a tenth around 1
            lam, totals = 1 + 0.17 * lam, first
        return np.exp(digamma(lam) - digamma(totals))
    first = np.full(k, float(max(1, m.terms.count())))

    def gammas(block: int, w: np.ndarray, b: Block, before: str | None) -> np.ndarray:
        if before is not None:
            return np.array(get_array(f"{folder}/{before}", str(block), np.float64)).reshape(-1, k)
        return np.repeat((1 + np.bincount(b.row, w, len(b.sizes)))[:, None] / k, k, axis=1)
    state, totals, before = "start", None, None
    for r in range(rounds):
        def work(block: int, state=state, totals=totals, before=before, now=f"mix{r}"):
            b = _open(folder, block)
            w, row = _weights(b, weight), b.row
            beta = likely(b.numbers, state, totals)
            gamma, theta, share = _mixes(w, row, b.codes, beta, gammas(block, w, b, before), E_STEPS)
            put(f"{folder}/{now}", str(block), [gamma.tobytes()], _attempt())
            return b.numbers, beta * np.stack([np.bincount(b.codes, share * theta[row, j], len(b.numbers)) for j in range(k)], axis=1)
        old, state, before = (state, before), f"lda{r}", f"mix{r}"
        got = _round(m, work, state, lambda total: (total + 1 / k, (total + 1 / k).sum(axis=0)))
        totals = got if got.size else first   # no term at all
        _drop(folder, *old)

    def of_terms(b: Block) -> np.ndarray:
        n = np.arange(len(b.numbers))
        known = (weight_of_one(b) > 0).astype(float)
        gamma = _mixes(known, n, n, likely(b.numbers, state, totals), np.repeat((1 + known)[:, None] / k, k, axis=1), LAST_STEPS)[0]
        return gamma / gamma.sum(axis=1)[:, None]

    def weight_of_one(b: Block) -> np.ndarray:
        return weight(Block(b.ids, b.words, np.ones(len(b.numbers), np.int32), np.arange(len(b.numbers)), np.ones(len(b.numbers)), b.numbers, b.df))

    def of_documents(block: int, b: Block, w: np.ndarray) -> np.ndarray:
        gamma = _mixes(w, b.row, b.codes, likely(b.numbers, state, totals), gammas(block, w, b, before), LAST_STEPS)[0]
        return gamma / gamma.sum(axis=1)[:, None]
    return of_terms, of_documents


def closest(m: Matrix, ids_kind: str, of_terms, of_documents, top: int) -> DataFrame:
    """Per document its ``top`` terms by cosine of the term's vector and the document's, ties to the last term:
    ``id, rank, term, sim``."""
    folder, k = m.folder, m.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                b = _open(folder, block)
                if not len(b.codes):
                    continue
                codes, row, words = b.codes, b.row, of_terms(b)
                docs = of_documents(block, b, words)
                norms = np.linalg.norm(docs, axis=1)[row] * np.linalg.norm(words, axis=1)[codes]
                dots = sum(docs[row, j] * words[codes, j] for j in range(k))
                sim = np.where(norms != 0, dots / np.where(norms != 0, norms, 1.0), 0.0)
                place = np.empty(len(b.words), np.int64)   # in byte order
                place[pc.sort_indices(b.words.cast(pa.binary())).to_numpy()] = np.arange(len(b.words))
                order = np.lexsort((-place[codes], -sim, row))
                rank = np.arange(len(order)) - (np.cumsum(b.sizes) - b.sizes)[row[order]] + 1
                passed = (rank <= top) & b.ids.is_valid().to_numpy(zero_copy_only=False)[row[order]]
                kept = order[passed]
                yield from pa.table({"id": b.ids.take(pa.array(row[kept])), "rank": pa.array(rank[passed].astype(np.int32)),
                                     "term": b.words.take(pa.array(codes[kept])), "sim": pa.array(sim[kept])}).to_batches(max_chunksize=50_000)
    return m.per_block(run, f"id {ids_kind}, rank int, term string, sim double")


def new_folder(df: DataFrame) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/topics-{uuid.uuid4().hex}"
