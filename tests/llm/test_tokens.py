"""Operators 3, 7 and 8 against the tokenizers library on whole texts."""

import hashlib
import random
import sys
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from featlab.llm import bpe, lexicon, token_count, token_files
from featlab.llm.pieces import PieceEncoder, safe_pieces, text_array
from featlab.llm.tokenizers_lib import library_encode

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'S", "é", "ü", "<|endoftext|>", "<|", "1", "23", "!!", "…", " ", "　", "\x1c", "\x85", "漢", "字",
         "😀", "é", "J̌", "the", " The", "ing", "\r\n", "'", "ll", "​", "٣", "²", "ß", "Ⅷ", " word.", " Word,", "İ", "Σ"]


def texts(n, longest=40, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


HARD = ["", " ", "\n", " " * 300, "a" * 3000, "ab" * 1500, "x " * 200 + "y" * 2500 + " z" * 200, "<|endoftext|>" * 40, "\x00", "end.", "end,\n", ". ,"]


def frame(spark, rows):
    """With NULLs, repeats, and extra columns whose names the operators use inside."""
    data = [(k, t, "x", 1) for k, t in enumerate(rows)] + [(None, "null id", "x", 1), (len(rows), None, "x", 1), (0, rows[0], "x", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, n_bytes string, rid int").repartition(3), [(d[0], d[1] or "") for d in data]


@pytest.mark.parametrize("path,byte_level", [(BYTE, True), (WORD, False)])
def test_pieces_give_the_library_ids(path, byte_level):
    rows = texts(4000) + HARD
    t = Tokenizer.from_file(path)
    want = [e.ids for e in t.encode_batch(rows, add_special_tokens=False)]
    run = PieceEncoder(library_encode(path), byte_level, memo_pieces=500)
    got = []
    for ids, lens in run(text_array(pa.array(rows))):
        ends = np.cumsum(lens)
        got += [ids[a:b].tolist() for a, b in zip(ends - lens, ends)]
    assert got == want
    assert run.lengths(text_array(pa.array(rows))).tolist() == [len(w) for w in want]


@pytest.mark.parametrize("path,byte_level", [(BYTE, True), (WORD, False)])
def test_every_letter_before_a_mark(path, byte_level):
    """Letters that the normaliser takes apart (dotted I, nukta and pointed letters) stay with the mark."""
    letters = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
    odd = [c for c in letters if not unicodedata.normalize("NFC", c).lower().isalpha()]
    assert len(odd) > 50
    rows = [f"x{a}. {a}, {b}x." for a, b in zip(letters, letters[1:] + letters[:1])] + [f"{c}{m} a{c}{m} {c}b{m} KED{c}{m}" for c in odd for m in ".,"]
    t = Tokenizer.from_file(path)
    want = [i for e in t.encode_batch(rows, add_special_tokens=False) for i in e.ids]
    got = [i for ids, _ in PieceEncoder(library_encode(path), byte_level)(text_array(pa.array(rows))) for i in ids.tolist()]
    assert got == want


def test_safe_pieces_join_to_the_text():
    for t in texts(500) + HARD:
        assert "".join(safe_pieces(t)) == t


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (30, 8), (400, 50)])
def test_token_counts(spark, chunk, overlap):
    df, rows = frame(spark, texts(150, 900) + HARD)
    t = Tokenizer.from_file(BYTE)
    want = Counter((k, len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for k, x in rows)
    got = token_count.count_tokens(df, BYTE, chunk=chunk, overlap=overlap, limit=20).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)
    # runs without boundaries were widened, others were spliced
    assert max(r.overlap for r in got) > overlap and max(r.chunks for r in got) > 3


def test_token_count_of_an_empty_table(spark):
    assert token_count.count_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTE).count() == 0


def test_token_files(spark):
    df, rows = frame(spark, texts(300) + HARD)
    manifest, folder = token_files.write_token_files(df, WORD, end_id=2)
    got = token_files.read_token_files(manifest, folder).collect()
    t = Tokenizer.from_file(WORD)
    start, want = 0, []
    for k, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.asarray([*t.encode(x, add_special_tokens=False).ids, 2], "<u4")
        want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted([tuple(r) for r in got], key=lambda r: r[1]) == want
    assert sum(r.ids for r in manifest.collect()) == start and {r.width for r in manifest.collect()} == {2}


def test_token_files_of_an_empty_table(spark):
    manifest, folder = token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), WORD)
    assert manifest.count() == 0 and token_files.read_token_files(manifest, folder).count() == 0


@pytest.mark.parametrize("size", [0, 60])
def test_bpe_round_trip(spark, size):
    df, rows = frame(spark, texts(600) + HARD)
    t = Tokenizer.from_file(BYTE)
    want = Counter()
    for k, x in rows:
        ids = t.encode(x, add_special_tokens=False).ids
        want[k, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(bpe.round_trip(df, BYTE, size)).collect())) == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(empty, BYTE).count() == 0


def test_encode_and_decode_apart(spark):
    df, rows = frame(spark, texts(50))
    folder = bpe.compile_lexicon(df, BYTE, 20)
    back = bpe.decode_rows(bpe.encode_rows(df, BYTE, folder), BYTE)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)


def test_frequent_words_count_the_whole_table(spark):
    df = spark.createDataFrame([(1, "the cat, the dog"), (2, "the end\nthe dog"), (3, None)], "doc_id long, text string")
    assert bpe.frequent_words(df, 2) == [" the", " dog"]


def test_long_words_merge_like_short_ones(monkeypatch):
    v = bpe.vocabulary(BYTE)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdethingé") for _ in range(rng.randint(1, 40))).encode() for _ in range(400)]
    assert [list(m) for m in v.merged_all(words)] == [v.merged(w) for w in words]


def test_lexicon_is_minimal_and_finds_exactly_its_words():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode() for _ in range(300)} | {b"xyzzy"})
    data = np.frombuffer(lexicon.build(words, [[k, k + 1][: 1 + k % 2] for k in range(len(words))]), "<i8")
    lex = lexicon.Lexicon(data)
    asked = words + [b"", b"q", b"xyzz", b"xyzzyy", b"abcabcabc"]
    ranks = lex.ranks(asked)
    assert ranks.tolist() == [*range(len(words)), -1, -1, -1, -1, -1]
    ids, lens = lex.outputs(ranks[: len(words)])
    assert lens.tolist() == [1 + k % 2 for k in range(len(words))] and ids[lens.cumsum() - lens].tolist() == list(range(len(words)))
    # Myhill-Nerode: as many states as distinct sets of endings (the empty set has none)
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    classes = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert lex.states == len(classes)
    assert lexicon.Lexicon(np.frombuffer(lexicon.build([], []), "<i8")).ranks([b"a"]).tolist() == [-1]


def test_plain_pieces_are_encoded_without_the_normaliser():
    import public_tokenizers
    from tokenizers import Tokenizer

    from featlab.llm import tokenizers_lib
    rng = random.Random(12)
    pieces = ["".join(rng.choice("aehinorstz") for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    pieces += ["The", "é", "x9", "a'b", "'s", ".", "<|endoftext|>", "", "zqx" * 40, "ſ", "漢字", "a<", "İ"] * 3
    rng.shuffle(pieces)
    for name, plain in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        assert (tokenizers_lib.plain_encode(path) is not None) == plain
        ids, lens = tokenizers_lib.library_encode(path)(pieces)
        t = Tokenizer.from_file(path)
        ends = lens.cumsum().tolist()
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [t.encode(p, add_special_tokens=False).ids for p in pieces]
        for some in ([], ["abc"], ["é"], ["abc", ""]):
            ids, lens = tokenizers_lib.library_encode(path)(some)
            assert lens.tolist() == [len(t.encode(p, add_special_tokens=False).ids) for p in some]
