"""Operator 6 against a direct recursive context-tree weighting and plain counts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from featlab.llm import context_tree as C

D = C.DEPTH


def kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


def model_bytes(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return b"\xff" * D + low.encode() + b"\xff"


def decisions(data):
    for i in range(D, len(data)):
        prefix = 1
        for j in range(7, -1, -1):
            bit = data[i] >> j & 1
            yield prefix, bytes(data[i - 1 - k] for k in range(D)), bit
            prefix = prefix << 1 | bit


class Tree:
    def __init__(self, texts, least=1):
        self.n = defaultdict(lambda: [0, 0])
        for t in texts:
            for prefix, context, bit in decisions(model_bytes(t)):
                for d in range(D + 1):
                    self.n[prefix, context[:d]][bit] += 1
        self.n = dict(self.n)
        self.children = defaultdict(list)
        for p, c in self.n:
            if c:
                self.children[p, c[:-1]].append((p, c))
        self.least, self.memo = least, {}

    def node(self, s):
        return s in self.n and sum(self.n[s]) >= self.least

    def rest(self, s):
        own = [c for c in self.children[s] if self.node(c)]
        return [self.n[s][k] - sum(self.n[c][k] for c in own) for k in (0, 1)], own

    def log_p(self, s):
        if s not in self.memo:
            if len(s[1]) == D:
                self.memo[s] = kt(*self.n[s])
            else:
                rest, own = self.rest(s)
                below = sum(map(self.log_p, own)) + kt(*rest)
                self.memo[s] = np.logaddexp(kt(*self.n[s]), below) - math.log(2)
        return self.memo[s]

    def one(self, prefix, context, d=0):
        s = (prefix, context[:d])
        if not self.node(s):
            if d == 0:
                return .5
            rest, _ = self.rest((prefix, context[:d - 1]))
            return (rest[1] + .5) / (sum(rest) + 1)
        est = (self.n[s][1] + .5) / (sum(self.n[s]) + 1)
        if d == D:
            return est
        w = math.exp(kt(*self.n[s]) - math.log(2) - self.log_p(s))
        return w * est + (1 - w) * self.one(prefix, context, d + 1)

    def score(self, text):
        total = 0.0
        for prefix, context, bit in decisions(model_bytes(text)):
            p = self.one(prefix, context)
            total += math.log10(p if bit else 1 - p)
        return total


TEXTS = ["the cat sat on the mat", "The Dog sat on the log\n\tand the cat", None, "", "   ", "été à la plage", "aaaaaaaaaaaaaaaaaaaaaa",
         "the cat sat on the mat", "x", "zebra quagga the cat"] + [f"the {w} number {k} and the rest" for k, w in enumerate("one two three four five six".split())]


def held_out(k):
    return zlib.crc32(str(k).encode()) % 5 == 1


@pytest.mark.parametrize("share", [C.NODE_SHARE, 0.02])
def test_scores_match_recursive_trees(spark, monkeypatch, share):
    monkeypatch.setattr(C, "NODE_SHARE", share)
    rows = list(enumerate(TEXTS)) + [(None, "no id at all"), (3, "")]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, score string")
    learned = [t for k, t in rows if k is None or not held_out(k)]
    size = sum(len(model_bytes(t)) - D for t in learned)
    tree = Tree(learned, max(1, math.ceil(size * share)))
    words = Counter(w for t in learned for w in re.findall(r"[^\x20\x09-\x0D]+", model_bytes(t)[D:-1].decode()))
    n, v = sum(words.values()) + len(learned), len(words) + 1
    got = defaultdict(list)
    for r in C.score_all(df).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for k, t in rows:
        want = tree.score(t)
        r = min(got[k], key=lambda r: abs(r.score - want))
        assert r.score == pytest.approx(want, rel=1e-9)
        toks = re.findall(r"[^\x20\x09-\x0D]+", model_bytes(t)[D:-1].decode())
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(toks) + 1, n, k is not None and held_out(k))
        assert r.n_known == sum(words[w] > 0 for w in toks) + 1
        base = sum(math.log10((words[w] + .5) / (n + .5 * (v + 1))) for w in toks) + math.log10((len(learned) + .5) / (n + .5 * (v + 1)))
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_probabilities_sum_to_one_over_next_bytes(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    model = C.train(df)
    nodes = C.open_table(model["nodes"][0], tuple(model["nodes"][1]), ("a", "r", "stop"))
    codes = (np.arange(256, dtype=np.uint64) << np.uint64(8 * D)) | np.uint64(int.from_bytes(b" taces"[:D], "big"))
    keys, bits = C.bit_nodes(codes)
    asked, which = np.unique(keys.reshape(-1), return_inverse=True)
    one = C.probability_of_one(nodes, asked)[which].reshape(-1, 8)
    assert np.where(bits == 1, one, 1 - one).prod(axis=1).sum() == pytest.approx(1, abs=1e-9)


def test_rare_contexts_of_a_large_corpus_are_nodes(spark):
    """Contexts that occur once among 10 MB of training text have nodes at all depths."""
    rare = next(k for k in range(1000, 1100) if not held_out(k))
    common = spark.range(100).selectExpr("id AS doc_id", "repeat('the cat sat on the mat. ', 5000) AS text")
    model = C.train(common.unionAll(spark.createDataFrame([(rare, "zebra quagga")], "doc_id long, text string")))
    assert model["least"] == 1
    nodes = C.open_table(model["nodes"][0], tuple(model["nodes"][1]), ("a", "r", "stop"))
    keys = np.unique([p << 8 * d | int.from_bytes(c[:d], "big") | d << 56 for p, c, _ in decisions(model_bytes("zebra quagga")) for d in range(D + 1)])
    assert nodes.find(keys.astype(np.int64))[0].all()


@pytest.mark.parametrize("frequent", [C.FREQUENT, 150, 0])
def test_texts_beyond_a_block_and_many_blocks(spark, monkeypatch, frequent):
    """Sums of answers at hand and answers from the parts equal a look-up in the whole model."""
    monkeypatch.setattr(C, "FREQUENT", frequent)
    long = "the cat sat on the mat, zebra. " * (C.BLOCK_BYTES // 31 + 1000)
    rows = [(k, "the cat sat on the log " * 20_000 + f"number {k}") for k in range(12)] + [(100, long), (101, None), (102, "quagga")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = C.train(df)
    nodes = C.open_table(model["nodes"][0], tuple(model["nodes"][1]), ("a", "r", "stop"))
    got = {r.doc_id: r for r in C.score(df, model).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        codes, _ = C.block_codes(pa.array([t or ""], pa.large_string()))
        distinct, where = np.unique(C.questions(codes), return_inverse=True)
        assert got[k].score == pytest.approx(C.answers(nodes, distinct)[where].sum(), rel=1e-9)
        assert got[k].n_bytes == len((t or "").encode()) + 1 and got[k].n_tokens == len((t or "").split()) + 1
    words = Counter(w for k, t in rows if not held_out(k) for w in (t or "").split())
    for k, t in rows:
        assert got[k].n_known == 1 + sum(words[w] > 0 for w in (t or "").split())


def test_packed_questions():
    for keys in (np.array([], np.uint64), np.array([0], np.uint64), np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64)) * np.uint64(2)):
        assert (C.unpack_sorted(C.pack_sorted(keys)) == keys).all()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert C.score_all(empty).count() == 0
    only_held = next(k for k in range(100) if held_out(k))
    r = C.score_all(spark.createDataFrame([(only_held, "ab")], "doc_id long, text string")).first()
    assert r.score == pytest.approx(24 * math.log10(.5)) and r.n_known == 0 and r.train_tokens == 0


def test_log_gamma():
    x = np.asarray([.5, 1, 1.5, 10.5, 1e3, 1e6 + .5, 1e9])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-9)
