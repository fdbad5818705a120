"""Operators 2, 5 and 9 against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from featlab.llm import exact_dedup, near_text, near_vectors
from featlab.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def joined(nodes, links):
    """Smallest node of each node's component."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 160)] + [(200, 200 + k) for k in range(1, 50)] + [(7, 7)]
    want = joined({x for p in links for x in p}, links)
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == {n: want[n] for n in got}
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


TEXTS = ["a  b", "a b", "a\tb", "a\n\nb", " a b", "", None, " ", "\t\n", "A b", "x" * 50_000, "x" * 50_000, "x" * 49_999, "é e", "é e", "\x1ca", "a b"]


def exact_frame(spark, rows):
    return spark.createDataFrame([(k, t, "clash", 9, "z") for k, t in rows], "doc_id long, text string, h string, rid int, norm string").repartition(3)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    rows = list(enumerate(TEXTS)) + [(100 + k, "many copies") for k in range(300)]
    kw = {"content_hash": lambda t: F.substring(F.md5(t), 1, 1)} if weak else {}  # one hex digit: nothing but collisions
    got = sorted(map(tuple, exact_dedup.exact_groups(exact_frame(spark, rows), **kw).collect()))
    groups = defaultdict(list)
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in rows}
    for k, _ in rows:
        groups[norm[k]].append(k)
    assert got == [(k, min(groups[norm[k]]), len(groups[norm[k]]), k == min(groups[norm[k]]), hashlib.sha256(norm[k].encode()).hexdigest()) for k, _ in sorted(rows)]


def test_exact_ties_nulls_and_empty_tables(spark):
    rows = [(5, "t"), (5, "t"), (None, "t"), (None, "u"), (2, "v")]
    got = exact_dedup.exact_groups(exact_frame(spark, rows)).collect()
    t = [r for r in got if r.group_size == 3]
    assert [r.keep_id for r in t] == [5, 5, 5] and [r.doc_id for r in t if r.kept] == [5]
    assert {(r.doc_id, r.keep_id, r.kept) for r in got if r.group_size == 1} == {(None, None, True), (2, 2, True)}
    assert exact_dedup.exact_groups(exact_frame(spark, [])).count() == 0
    df = exact_frame(spark, rows + [(9, "v")])
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "t"), (0, "u"), (2, "v"), (5, "t"), (5, "t")]


def test_other_texts_of_a_dropped_id_stay(spark):
    rows = [(3, "a"), (5, "a"), (5, "unique"), (6, None), (7, " a"), (7, "")]
    kept = exact_dedup.drop_copies(exact_frame(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, "a"), (5, "unique"), (6, None), (7, " a")]


def test_one_row_of_each_text_stays(spark):
    rows = [(5, "t"), (5, "t"), (None, "t"), (None, "u"), (None, "u "), (2, "v"), (9, "v"), (9, "w"), (9, " w"), (9, "  w"), (1, None), (1, "")]
    df = exact_frame(spark, rows)
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, (r.text or "").strip()) for r in kept.collect()) == [(0, "u"), (0, "u"), (1, ""), (2, "v"), (5, "t"), (9, "w"), (9, "w")]
    clash = df.withColumn("_dropped_id", exact_dedup.F.lit("x")).withColumn("_dropped_hash", exact_dedup.F.lit("y"))
    assert exact_dedup.keep_first(clash).count() == 7 and exact_dedup.keep_first(df.limit(0)).count() == 0


def test_near_stage_keeps_other_texts_of_a_dropped_id(spark):
    w = " ".join(f"w{k}" for k in range(40))
    other = " ".join(f"x{k}" for k in range(40))
    df = spark.createDataFrame([(1, w), (2, w), (2, other), (3, w + " more")], "doc_id long, text string")
    assert sorted(tuple(r) for r in near_text.drop_near_duplicates(df).collect()) == [(1, w), (2, other)]


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near_rows():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    rows, base = [], [rng.choice(words) for _ in range(120)]
    for k in range(160):  # a large group of near copies at all distances
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append(" ".join(w))
    passage = " ".join(rng.choice(words) for _ in range(60))
    for k in range(60):  # a passage that unlike texts share
        rows.append(" ".join(rng.choice(words) for _ in range(25)) + " " + passage)
    for k in range(40):
        t = [rng.choice(words) for _ in range(rng.randint(1, 30))]
        rows += [" ".join(t), "\n\t ".join(t).upper(), " ".join(t[:-1] + ["other"])]
    rows += ["one two", "ONE  two", "one", "", None, " \n", "a b c d e", "a b c d", "é É x y z w", "é é x y z w"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [16, 256])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_text, "BLOCK", block)
    rows = near_rows()
    sets = {k: shingles(t) for k, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = joined(ids, links)
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], "doc_id long, text string, sketch string, comp string").repartition(3)
    got = near_text.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(k, len(sets[k]), want[k], want[k] == k) for k in ids]
    kept = near_text.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_without_rows_or_ids(spark):
    assert near_text.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = near_text.near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (3, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (3, 3, True), (4, 4, True), (4, 4, True)]


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for share in (0.6, 0.75, 0.9):
        n = int(2000 * (1 - share) / (1 + share))
        y = np.concatenate([x[n:], rng.integers(0, 1 << 63, n, dtype=np.uint64)])
        s = near_text.odd_sketches(np.stack([near_text.min_samples(np.unique(v)) for v in (x, y)]))
        odd = int(np.unpackbits(s[0] ^ s[1]).sum())
        bits = near_text.SKETCH_BITS
        estimate = 1 + bits / (4 * near_text.SAMPLES) * np.log(1 - 2 * odd / bits)
        assert abs(estimate - share) < 0.12
    assert near_text.most_differing_bits() < near_text.SKETCH_BITS * 0.3


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 16))
    vecs = [c + s * rng.standard_normal(16) for c in centre for s in rng.uniform(0, .2, 60)]
    vecs += [vecs[0], vecs[0] * 3, -vecs[1], np.zeros(16), vecs[2]]
    rows = [(k, [float(np.float32(x)) for x in v], k % 2 if k < 300 else 0, "x") for k, v in enumerate(vecs)]
    rows += [(900, None, 0, "x"), (901, [float("nan")] + [1.0] * 15, 0, "x"), (902, [None] + [1.0] * 15, 0, "x"), (903, [1.0, 2.0], 0, "x"), (904, [2.0, 4.0], 0, "x"),
             (905, rows[0][1], None, "x"), (906, [float("inf")] * 16, 0, "x"), (907, [], 0, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cid string").repartition(3)

    def linked(p, q):
        x, y = p[1], q[1]
        if p[2] is None or p[2] != q[2] or not x or not y or len(x) != len(y):
            return False
        if any(v is None or not np.isfinite(v) for v in x + y):
            return False
        x, y = np.asarray(x, np.float32).astype(float), np.asarray(y, np.float32).astype(float)
        n = np.linalg.norm(x) * np.linalg.norm(y)
        return n > 0 and x @ y / n >= 0.98
    links = [(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and linked(p, q)]
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = joined([r[0] for r in rows], links)
    assert len(links) > 2000
    for block in (16, 256):
        near_vectors.BLOCK, old = block, near_vectors.BLOCK
        got = near_vectors.near_vectors(df).collect()
        near_vectors.BLOCK = old
        assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(k, n[k], want[k], want[k] == k) for k in sorted(want)]
    assert near_vectors.near_vectors(spark.createDataFrame([], df.schema)).count() == 0
    nulls = near_vectors.near_vectors(spark.createDataFrame([(None, [1.0], 1, "x"), (1, [1.0], 1, "x"), (1, [1.0], 1, "x")], df.schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.class_size) for r in nulls) == [(0, 0, 1), (1, 1, 2), (1, 1, 2)]


def test_table_count_bounds_the_misses():
    import math
    for bits in (8, 14):
        p = (1 - math.acos(0.98) / math.pi) ** bits
        assert (1 - p) ** near_vectors.table_count(0.98, bits) <= near_vectors.MISS
