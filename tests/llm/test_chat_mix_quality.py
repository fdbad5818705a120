"""Operators 1, 4 and 10."""

import hashlib
import itertools
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from featlab.llm import chat_format as chat
from featlab.llm import line_crf, mixing

# --- chat ---

NASTY = ["", "plain", "\\", "\\\\", "### User: hi", "</turn>", "</turn>\n", "\\### Assistant: </turn> ok", "#### User:", "### Role x: ", "a\\</turn>\n### User: b",
         "</tur", "n>\n", "\n", "<", "é😀", "$1 \\1", "### System:### Assistant:", "<\\/turn>"]


def conversations(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "clash") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, segments string").repartition(3)


def test_chat_reads_back_what_was_written(spark):
    rng = random.Random(1)
    roles = ["system", "user", "assistant", "tool", "we: ird\\", "</turn>\n", "", None]
    rows = [(c, t, rng.choice(roles), rng.choice([*NASTY, None])) for c in range(60) for t in range(rng.randint(1, 6))]
    got = {r.conv_id: r for r in chat.formatted(conversations(spark, rows)).select("*", chat.read_back(chat.F.col("formatted")).alias("turns")).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in turns]
        assert got[c].formatted == "".join(s.text for s in got[c].segments)
        # each assistant text once, escaped, nothing else under the mask
        assert [s.text.count("</turn>") for s in got[c].segments if s.loss] == [0] * sum(r == "assistant" for _, r, _ in turns)


OTHER = chat.Template(headers={"system": "<|im_start|>system\n", "user": "<|im_start|>user\n", "assistant": "<|im_start|>assistant\n"},
                      other="<|im_start|>role ", end="<|im_end|>", between="\n")
NESTED = chat.Template(headers={"system": "a[[sys]]b", "user": "[[sys]]", "assistant": "]]a[["}, other="<[[sys]]> ", end="(.*)+?$", between="")


@pytest.mark.parametrize("template", [OTHER, NESTED])
def test_templates_with_pattern_signs_and_nested_strings(spark, template):
    rng = random.Random(2)
    texts = [*NASTY, "<|im_end|>", "<|im_end|>\n", "<|im_start|>user\nhi<|im_end|>\n", "|", "[[", "[[sys]]", "[[sys]x", "(.*)+?$", "a(.*)+?", "$", "\\E", "\\Q[["]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "we: ird\\", "[[", None]), rng.choice([*texts, None])) for c in range(80) for t in range(rng.randint(1, 6))]
    found = chat.formatted(conversations(spark, rows), template)
    got = {r.conv_id: r for r in found.select("*", chat.read_back(chat.F.col("formatted"), template).alias("turns")).collect()}
    for c in got:
        turns = sorted((t, r or "", x or "") for k, t, r, x in rows if k == c)
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in turns]


def test_templates_that_cannot_be_escaped_are_refused():
    for bad in ({"end": "|"}, {"end": "\\end"}, {"end": "abab"}, {"between": "\\"}, {"headers": {"user": "u "}},
                {"headers": {"user": "[[", "assistant": "[[a"}}, {"other": "### User: x"}):
        with pytest.raises(ValueError):
            chat.Template(**bad)


def test_chat_digests(spark):
    sample = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", sample), (-7, 1, "assistant", sample), (1, 0, "user", "q"), (1, 1, "assistant", None), (1, 2, "user", "")]
    got = {r.conv_id: r for r in chat.digests(chat.formatted(conversations(spark, rows))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[-7].turns_sha256 == sha(f"user\n{sample}\nassistant\n{sample}\n") and got[-7].loss_sha256 == sha(sample) and got[-7].loss_chars == len(sample)
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 0, sha(""))


def accepts(roles):
    state = chat.START
    for r in roles:
        if r not in chat.Template().follows.get(state, ()):
            return False
        state = r
    return state in chat.Template().final


def test_chat_automaton(spark):
    orders = [p for n in range(1, 5) for p in itertools.product(["system", "user", "assistant", "tool"], repeat=n)]
    df = conversations(spark, [(c, t, r, "x") for c, p in enumerate(orders) for t, r in enumerate(p)])
    got = {r.conv_id: r for r in chat.formatted(df).collect()}
    assert all(got[c].valid == accepts(p) for c, p in enumerate(orders))
    turns = defaultdict(list)
    for r in chat.turn_segments(df).orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append(r.valid)
    for c in got:
        bad = next((k for k, ok in enumerate(turns[c]) if not ok), None)
        assert bad == got[c].first_bad
    assert chat.formatted(conversations(spark, [])).count() == 0


# --- mixing ---

def expected_mix(items, mix):
    leaves = defaultdict(int)
    for _, *leaf, n in items:
        if n > 0:
            leaves[tuple(leaf)] += n

    def share(given, caps, weights):
        """Water filling by repeated rounds with exact fractions: siblings take over what a full one leaves."""
        out, left, live = {}, Fraction(given), sorted(caps)
        while True:
            w = sum(weights[c] for c in live)
            full = [c for c in live if caps[c] * w <= weights[c] * left]
            if not full or not live:
                break
            for c in full:
                out[c] = caps[c]
                left -= caps[c]
                live.remove(c)
        shares = {c: left * weights[c] / sum(weights[x] for x in live) for c in live}
        return out, shares

    def budgets(prefix, given):
        children = sorted({k[: len(prefix) + 1] for k in leaves if k[: len(prefix)] == prefix})
        if len(prefix) == len(mixing.LEVELS):
            return {prefix: given}
        caps = {c: sum(n * mix.max_epochs for k, n in leaves.items() if k[: len(c)] == c) for c in children}
        weights = {c: mix.weights.get("/".join(c), 1) for c in children}
        out, shares = share(given, caps, weights)
        # whole tokens: running shares in the order of capacity by weight
        run = Fraction(0)
        for c in sorted(shares, key=lambda c: (caps[c] / weights[c], c)):
            out[c] = (run + shares[c]).__floor__() - run.__floor__()
            run += shares[c]
        return {k: v for c in children for k, v in budgets(c, out[c]).items()}
    given = sum(leaves.values()) * mix.budget_permille // 1000
    rows = []
    for leaf, budget in budgets((), given).items():
        at = 0
        for epoch in range(mix.max_epochs):
            docs = sorted((hashlib.md5(f"{mix.seed}:{epoch}:{'' if k is None else k}".encode()).hexdigest(), -1 if k is None else k, n, k)
                          for k, *path, n in items if tuple(path) == leaf and n > 0)
            for *_, n, k in docs:
                if at < budget:
                    rows.append((k, *leaf, epoch, at, n, min(n, budget - at)))
                at += n
    return rows


@pytest.mark.parametrize("permille,epochs,bucket", [(800, 3, 3), (1000, 1, 1000), (2500, 3, 5), (300, 2, 1), (3000, 3, 7), (0, 2, 5)])
def test_mixing(spark, permille, epochs, bucket):
    rng = random.Random(permille)
    items = [(k, rng.choice("AB"), rng.choice(["en", "de", ""]), rng.choice(["s1", "s2", "s3"]), rng.choice([0, 1, 3, 50])) for k in range(150)]
    items += [(1000 + k, "A", "en", "big", 7) for k in range(120)]  # a hot leaf
    items += [(5, "B", "de", "s1", 4), (None, "B", "de", "s1", 4)]
    weights = {"A": 5, "B": 2, "A/en": 7, "A/de": 1, "B/de": 9, "A/en/big": 1, "A/en/s1": 6, "B/de/s2": 3}
    mix = mixing.Mix(weights=weights, budget_permille=permille, max_epochs=epochs, bucket_rows=bucket)
    df = spark.createDataFrame(items, "doc_id long, domain string, lang string, source string, n_tokens long").repartition(3)
    got = [tuple(r) for r in mixing.select_prefixes(df, mix).collect()]
    key = lambda r: (r[1:6], r[0] or 0)
    assert sorted(got, key=key) == sorted(expected_mix(items, mix), key=key)
    total = sum(n for *_, n in items)
    assert sum(r[-1] for r in got) == min(total * permille // 1000, total * epochs)


def test_mixing_of_nulls_and_empty_tables(spark):
    schema = "doc_id long, lang string, source string, text string, budget int, h string"
    df = spark.createDataFrame([(1, None, None, "a b c", 1, "x"), (2, "en", "src1", None, 1, "x"), (3, "en", "src1", " \n", 1, "x"), (None, "en", "src3", "d e", 1, "x")], schema)
    mix = mixing.Mix(budget_permille=1000, max_epochs=1)
    assert {r.doc_id for r in mixing.select_prefixes(mixing.items_of(df), mix).collect()} == {1, None}
    kept = mixing.drop_unmixed(df, mix)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, None}
    assert mixing.select_prefixes(mixing.items_of(spark.createDataFrame([], schema)), mix).count() == 0


# --- quality ---

def brute_chain(emission, t):
    """Marginals, expected transitions and log partition by enumeration."""
    n = len(emission)
    good, pairs, total = np.zeros(n), np.zeros((2, 2)), 0.0
    for y in itertools.product([0, 1], repeat=n):
        p = np.exp(sum(e for e, v in zip(emission, y) if v) + sum(t[a, b] for a, b in zip(y, y[1:])))
        total += p
        good += p * np.asarray(y)
        for a, b in zip(y, y[1:]):
            pairs[a, b] += p
    return good / total, pairs / total, np.log(total)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    counts = np.asarray([3, 1, 6, 2, 1, 5])
    e, t = rng.standard_normal(counts.sum()) * 2, rng.standard_normal((2, 2))
    good, pairs, total = line_crf.forward_backward(e, counts, t, pairs=True)
    want = [brute_chain(x, t) for x in np.split(e, np.cumsum(counts)[:-1])]
    assert np.allclose(good, np.concatenate([w[0] for w in want])) and np.allclose(pairs, sum(w[1] for w in want)) and np.isclose(total, sum(w[2] for w in want))


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(2)
    counts, t = np.asarray([4, 2, 3]), rng.standard_normal((2, 2))
    x, w, y = rng.standard_normal((9, 3)), rng.standard_normal(3), rng.integers(0, 2, 9)
    inner = [k for k in range(8) if k + 1 not in np.cumsum(counts)]

    def loss(w, t):
        return (x @ w) @ y + sum(t[y[k], y[k + 1]] for k in inner) - line_crf.forward_backward(x @ w, counts, t, pairs=True)[2]
    good, pairs, _ = line_crf.forward_backward(x @ w, counts, t, pairs=True)
    h = 1e-6
    for k in range(3):
        d = np.eye(3)[k] * h
        assert np.isclose((loss(w + d, t) - loss(w - d, t)) / (2 * h), ((y - good) @ x)[k], atol=1e-5)
    d = np.zeros((2, 2))
    d[0, 1] = h
    seen = sum(1 for k in inner if (y[k], y[k + 1]) == (0, 1))
    assert np.isclose((loss(w, t + d) - loss(w, t - d)) / (2 * h), seen - pairs[0, 1], atol=1e-5)


def test_features_of_a_block_equal_those_of_single_texts():
    texts = ["", "One line.", "A A A A\nA A A A\n\nThe end!", "| x | y |", "é à", "\n\n", "###***"]
    whole = [np.concatenate(v) for v in zip(*line_crf.line_features(pa.array(texts, pa.large_string())))]
    single = [np.concatenate(v) for v in zip(*(next(iter(line_crf.line_features(pa.array([t], pa.large_string())))) for t in texts))]
    assert all(np.allclose(a, b) for a, b in zip(whole, single)) and whole[2].tolist() == [t.count("\n") + 1 for t in texts]


def test_document_score_is_the_weighted_mean_over_all_label_paths(spark):
    """quality_of against a plain loop over the label paths of every document."""
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["A fine line, with words in it.\nBUY NOW!!! $$$\n\nAnd one more sentence here.", "", None, "x\n" * 4 + "|||", "one line"])],
                                 "doc_id long, text string")
    train_docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = line_crf.train(train_docs, labels)
    got = {r.doc_id: r.score for r in line_crf.classify(docs, model).collect()}
    for row in docs.collect():
        (x, size, counts), = line_crf.line_features(pa.array([row.text or ""], pa.large_string()))
        e = model.emissions(line_crf.with_neighbours(x, counts))
        n, total, good = len(x), 0.0, np.zeros(len(x))
        for path in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(e[k][path[k]] if np.ndim(e[k]) else e[k] * path[k] for k in range(n)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:])))
            total += w
            good += w * np.array(path)
        want = float(np.sum(good / total * (size + 1)) / np.sum(size + 1))
        assert got[row.doc_id] == pytest.approx(want, abs=1e-9)


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.withColumn("quality", docs.n_chars).withColumn("score", docs.lang)  # clashing names
    got = {r.doc_id: r for r in line_crf.quality_of(docs, labels).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(got) == docs.count() and len(held) > 50
    assert np.mean([p.predicted == q for p, q in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    kept = line_crf.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got.values())


def test_good_text_under_a_rejected_id_stays(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.predicted for r in line_crf.quality_of(docs, labels).collect()}
    labelled = {r.doc_id for r in labels.collect()}
    bad, good = (min(k for k, p in got.items() if p == v and k not in labelled) for v in (0, 1))
    extra = docs.filter(docs.doc_id == good).withColumn("doc_id", F.lit(bad).cast("long"))
    kept = line_crf.keep_good(docs.unionByName(extra), labels)
    want = extra.first().text
    assert [r.text for r in kept.filter(kept.doc_id == bad).collect()] == [want] and kept.count() == sum(got.values()) + 1


def test_classifier_without_labels_or_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "a"), (None, None), (2, "")], schema)
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert {(r.doc_id, r.score, r.predicted) for r in line_crf.quality_of(docs, none).collect()} == {(1, .5, 1), (None, .5, 1), (2, .5, 1)}
    assert line_crf.quality_of(spark.createDataFrame([], schema), none).count() == 0
