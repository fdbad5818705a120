"""Operator 11: every id in one piece, little padding, and placement by the sum of squares."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from featlab.llm import packing, queries

WORD = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def ids_of(text):
    return [*Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids, 1]


def check_sequences(rows, window):
    """Offsets gapless from 0; lengths the window or a power of two."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    padding = 0
    for pieces in by.values():
        pieces.sort()
        fill = 0
        for offset, length in pieces:
            assert offset == fill and length > 0
            fill += length
        assert fill <= window
        padding += 0 if fill & (fill - 1) == 0 else window - fill
    return padding


def check_documents(rows, want):
    """Pieces of each document in order give its ids; ``want``: lists of ids (documents with equal ids: any order)."""
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(got) == set(want)
    for doc, lists in want.items():
        left = sorted(got[doc])
        for ids in lists:
            at = 0
            while at < len(ids):
                k = next(k for k, p in enumerate(left) if p[0] == at and p[3] == len(ids) and p[2] == zlib.crc32(np.asarray(ids[at:at + p[1]], "<u4").tobytes()))
                at += left.pop(k)[1]
            assert at == len(ids)
        assert not left


def test_level_is_the_least_sum_of_squares():
    rng = random.Random(3)
    p = packing.Packer(window=64, open_windows=10_000)
    for k in range(3000):
        size = rng.choice([3, 7, 9, 20, 31, 33, 40, 63, rng.randint(1, 63)])

        def after(h):
            c = p.counts.copy()
            if h:
                c[h] -= 1
            if h + size < 64:
                c[h + size] += 1
            return int((c ** 2).sum())
        choices = [h for h in range(0, 65 - size) if h == 0 or p.counts[h]]
        least = min(map(after, choices))
        assert p.level(size) == max(h for h in choices if after(h) == least)
        p.add(k, np.arange(size, dtype="<u4"))
        assert p.n_open == p.counts.sum() == sum(map(len, p.at.values()))


def test_packer_closes_everything():
    rng = random.Random(4)
    for most in (0, 3, 1000):
        p = packing.Packer(window=32, open_windows=most)
        docs = [np.arange(rng.choice([1, 5, 17, 31, 32, 33, 64, 100]), dtype="<u4") for _ in range(200)]
        for k, d in enumerate(docs):
            p.add(k, d)
            assert p.n_open <= max(most, 1)
        p.finish()
        assert not p.n_open and sum(len(x[2]) // 4 for w in p.closed for x in w) == sum(map(len, docs))
        sizes = [sum(len(x[2]) // 4 for x in w) for w in p.closed]
        assert all(s == 32 for s in sizes[:-5]) and all(s & (s - 1) == 0 for s in sizes)
        found = defaultdict(dict)
        for w in p.closed:
            for doc, start, ids, total in w:
                assert total == len(docs[doc])
                found[doc][start] = np.frombuffer(ids, "<u4")
        for k, d in enumerate(docs):
            assert np.concatenate([found[k][s] for s in sorted(found[k])]).tolist() == d.tolist()


def test_odd_rows(spark):
    rng = random.Random(2)
    data = [(k, " ".join(rng.choice(["the", "Word", "x̧", "12", "<|endoftext|>", "İ."]) for _ in range(rng.choice([0, 1, 5, 50, 300, 2000])))) for k in range(60)]
    data += [(None, "null id"), (None, None), (60, None), (3, "other text"), (4, data[4][1]), (61, "word " * 9000)]
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in data], "doc_id long, text string, start int, part string, ids int").repartition(3)
    want = defaultdict(list)
    for k, t in data:
        want[k].append(ids_of(t))
    pieces = packing.pack(df, WORD, window=256)
    rows = packing.digests(pieces).collect()
    check_documents(rows, want)
    assert check_sequences(rows, 256) == 0
    whole = packing.sequences(pieces, 256).collect()
    assert sum(len(w.ids) // 4 for w in whole) == sum(len(i) for x in want.values() for i in x)
    assert all(len(w.ids) == 4 * w.length and w.length == w.padded_length for w in whole)
    assert packing.pack(df.limit(0), WORD).count() == 0


def test_query(spark):
    rows = queries.QUERIES["op11_sum_of_squares_packing"](spark, SF).collect()
    want = defaultdict(list)
    t = Tokenizer.from_file(WORD)
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        want[r.doc_id].append([*t.encode(r.text or "", add_special_tokens=False).ids, 1])
    check_documents(rows, want)
    assert check_sequences(rows, 2048) == 0
