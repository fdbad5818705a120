"""Tokenizers, WordPiece, stemming, segmentation, dates: literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from featlab.functions import dates as D
from featlab.functions import text as T
from featlab.operators import segmentation as SG


def test_basic_tokenizer_cjk_punct_accents(spark):
    df = spark.createDataFrame([("a中b Héllo,\tWörld!\x00",)], "t string")
    toks = df.select(T.basic_tokens("t").alias("x")).first().x
    assert toks == ["a", "中", "b", "hello", ",", "world", "!"]


def test_ngrams_and_word_tokens(spark):
    df = spark.createDataFrame([("The cat sat",)], "t string")
    g = df.select(T.ngrams(T.word_tokens("t"), 1, 3).alias("g")).first().g
    assert g == ["the", "cat", "sat", "the cat", "cat sat", "the cat sat"]


def brute_wordpiece(token, vocab, unk="[UNK]"):
    """Every split into vocabulary entries whose pieces are each the longest at their place."""
    def entry(i, j):
        return token[i:j] if i == 0 else "##" + token[i:j]
    if len(token) > 100:
        return [unk]
    out, i = [], 0
    while i < len(token):
        ends = [j for j in range(i + 1, len(token) + 1) if entry(i, j) in vocab]
        if not ends:
            return [unk]
        out.append(entry(i, max(ends)))
        i = max(ends)
    return out


def test_wordpiece(spark):
    import random
    rng = random.Random(1)
    vocab = {"un", "##aff", "##able", "##a", "u" * 101, "##", "##x##y"} | {rng.choice(["", "##"]) + "".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(25)}
    toks = ["unaffable", "xyz", "u" * 101, "un", "", "##a", "##"] + ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(toks)] + [(-1, None)], "pos int, token string")
    out = {r.pos: r.pieces for r in SG.wordpiece_tokens(df, "token", spark.createDataFrame([(v,) for v in vocab], "token string")).collect()}
    assert out.pop(-1) is None and len(out) == len(toks)
    assert out == {k: brute_wordpiece(t, vocab) for k, t in enumerate(toks)}


def test_porter_stemmer_published_examples():
    cases = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre",
             "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat",
             "troubled": "troubl", "sized": "size", "hopping": "hop", "filing": "file", "happy": "happi",
             "relational": "relat", "adjustment": "adjust", "controll": "control", "roll": "roll"}
    assert {w: SG.porter_stem(w) for w in cases} == cases


def test_segmentation_prefers_dictionary_words(spark):
    d = spark.createDataFrame([("北京", 100), ("大学", 100), ("北京大学", 50), ("生", 10)], "word string, freq bigint")
    df = spark.createDataFrame([("北京大学生",)], "t string")
    words = SG.segment_text(df, "t", d).first().words
    assert "".join(words) == "北京大学生" and words[0] in ("北京", "北京大学")


def test_segmentation_finds_the_most_probable_split(spark):
    import itertools
    import math
    import random
    rng = random.Random(2)
    freq = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): rng.randint(1, 50) for _ in range(30)}
    total = sum(freq.values())
    texts = ["".join(rng.choice("abcd") for _ in range(n)) for n in range(1, 9) for _ in range(6)]
    d = spark.createDataFrame(list(freq.items()), "word string, freq bigint")
    out = {r.t: r.words for r in SG.segment_text(spark.createDataFrame([(t,) for t in texts + [""]] + [(None,)], "t string"), "t", d).collect()}
    assert out[""] == [] and out[None] is None

    def value(words):
        return sum(math.log(freq.get(w, 1) / total) for w in words)
    for t in texts:
        splits = []
        for cuts in itertools.product([0, 1], repeat=len(t) - 1):
            at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(t)]
            words = [t[a:b] for a, b in zip(at, at[1:])]
            if all(len(w) == 1 or w in freq for w in words):
                splits.append(words)
        assert "".join(out[t]) == t and abs(value(out[t]) - max(map(value, splits))) < 1e-9


def test_suggested_frequencies(spark):
    d = spark.createDataFrame([("ab", 100), ("a", 30), ("b", 30), ("aa", 1)], "word string, freq bigint")
    freq = lambda t: {r.word: r.freq for r in t.collect()}
    # keeping a word never lowers it, breaking it never raises it
    assert freq(SG.suggest_freq(d, "ab"))["ab"] >= 100
    assert freq(SG.suggest_freq(d, "ab", parts=["a", "b"]))["ab"] == int(30 * 30 / 161)
    assert freq(SG.suggest_freq(d, "zz", parts=["z", "z"]))["zz"] == 0
    # a repeated piece counts each time
    assert freq(SG.suggest_freq(d.filter("word <> 'aa'"), "aaa"))["aaa"] == int((30 / 160) ** 3 * 160) + 1


def test_dictionary_matches(spark):
    d = spark.createDataFrame([("ab",), ("bc",), ("abc",)], "word string")
    df = spark.createDataFrame([(1, "xabcx")], "id int, t string")
    got = sorted((r.start, r.word) for r in SG.dictionary_matches(df, "id", "t", d).collect())
    assert got == [(2, "ab"), (2, "abc"), (3, "bc")]


def test_cn_numerals(spark):
    vals = ["十", "十五", "三十五", "一百一", "零", "12", "x", "二百三十四", "一千零五", "", None, "三x"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(D.cn_number("s")).collect()]
    assert got == [10, 15, 35, 101, 0, 12, None, 234, 1005, None, None, None]


def test_cn_datetime(spark):
    asof = dt.datetime(2024, 3, 10, 8, 0, 0)
    df = spark.createDataFrame([("下午3点", asof), ("2023年5月6日", asof), ("2024-01-02 03:04:05", asof)],
                               "s string, a timestamp")
    got = [r[0] for r in df.select(D.parse_cn_datetime("s", "a")).collect()]
    assert got[0] == dt.datetime(2024, 3, 10, 15, 0, 0)
    assert got[1] == dt.datetime(2023, 5, 6, 0, 0, 0)
    assert got[2] == dt.datetime(2024, 1, 2, 3, 4, 5)
    rel = df.select(D.relative_day_mentions(F.lit("明天见"), "a")).first()[0]
    assert rel == [dt.date(2024, 3, 11)]


def test_times_mentioned_in_a_text(spark):
    asof = dt.datetime(2024, 3, 10, 8, 0, 0)
    texts = ["明天下午3点半见", "会议在2023年5月6日十点二十分", "今天", "编号12345", "后天晚上八点", "没有"]
    df = spark.createDataFrame([(t, asof) for t in texts], "s string, a timestamp")
    got = [r[0] for r in df.select(D.mentioned_times("s", "a")).collect()]
    assert got == [[dt.datetime(2024, 3, 11, 15)], [dt.datetime(2023, 5, 6, 10, 20)], [dt.datetime(2024, 3, 10)], [], [dt.datetime(2024, 3, 12, 20)], []]


def test_valid_time_word(spark):
    df = spark.createDataFrame([("12345",), ("5日3",), ("2024年",)], "s string")
    assert [r[0] for r in df.select(D.valid_time_word("s")).collect()] == [None, "5日", "2024年"]


def test_full_and_char_tokenizers(spark):
    vocab = spark.createDataFrame([("un", 1), ("##aff", 2), ("##able", 3), ("!", 4)], "token string, id long")
    df = spark.createDataFrame([(1, "Unaffable!")], "id int, t string")
    got = [(r.pos, r.sub, r.piece, r.piece_id) for r in
           SG.full_tokenize(df, "id", "t", vocab).orderBy("pos", "sub").collect()]
    assert got == [(0, 0, "un", 1), (0, 1, "##aff", 2), (0, 2, "##able", 3), (1, 0, "!", 4)]
    c = SG.char_tokenize(spark.createDataFrame([(1, "UN xyz")], "id int, t string"), "id", "t", vocab)
    assert {r.token: list(r.pieces) for r in c.collect()} == {"un": ["un"], "xyz": ["[UNK]"]}


def test_unique_and_setdiff(spark):
    from featlab.operators.text_features import setdiff_positions, unique_with_index
    df = spark.createDataFrame([(0, 0, "b"), (0, 1, "a"), (0, 2, "b"), (0, 3, "c")], "g int, pos int, v string")
    u = {r.pos: r.idx for r in unique_with_index(df, ["g"], "pos", "v").collect()}
    assert u == {0: 0, 1: 1, 2: 0, 3: 2}
    rm = spark.createDataFrame([("b",)], "v string")
    assert sorted(r.pos for r in setdiff_positions(df, rm, "v").collect()) == [1, 3]


def test_document_windows_pairs_and_pieces(spark, tmp_path):
    """Every token of every document has its window, its pairs and its pieces."""
    import re
    from collections import Counter

    from featlab.plans import registry
    registry.load_all()
    texts = {1: "the cat sat on the mat", 2: "", 3: "The", 4: "un cat " * 3000, 5: None, 6: "cats, unmat the-cat"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    toks = {k: re.findall("[a-z]+", (t or "").lower()) for k, t in texts.items()}
    at = lambda w, i: w[i] if 0 <= i < len(w) else None
    run = lambda name: sorted(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).collect()), key=str)
    windows = [(k, i + 1, t, at(w, i - 1), at(w, i - 2), at(w, i + 1), at(w, i + 2)) for k, w in toks.items() for i, t in enumerate(w)]
    assert run("w05_document_windows") == sorted(windows, key=str)
    pairs = [(k, i + 1, d, t, w[i + d]) for k, w in toks.items() for i, t in enumerate(w) for d in (-2, -1, 1, 2) if 0 <= i + d < len(w)]
    assert run("w06_document_pairs") == sorted(pairs, key=str)
    words = Counter(t for w in toks.values() for t in w)
    vocab = set(words) | {f"##{t[-n:]}" for t in words for n in (2, 3)}
    pieces = [(k, i, t, " ".join(brute_wordpiece(t, vocab))) for k, w in toks.items() for i, t in enumerate(w)]
    assert run("x08_document_wordpiece") == sorted(pieces, key=str)


def test_words_longer_than_a_place_carries(spark):
    """Long words are found by their beginning and compared with the text."""
    from featlab.operators.segmentation import PLACE, dictionary_matches
    long, other = "ab" * PLACE, "ab" * (PLACE - 1) + "xy"
    texts = [(1, f"xx{long}yab"), (1, other), (2, "ab" * 20), (None, long), (3, None), (4, "")]
    words = ["ab", long, other, "ab" * (PLACE // 2), "ab" * (PLACE // 2) + "a"]
    df = spark.createDataFrame(texts, "id long, text string")
    got = sorted(((r.id or 0, r.start, r.word) for r in dictionary_matches(df, "id", "text", spark.createDataFrame([(w,) for w in words], "word string")).collect()))
    want = sorted((k or 0, s + 1, w) for k, t in texts if t for w in words for s in range(len(t)) if t.startswith(w, s))
    assert got == want


def test_dictionary_matches_pass_on_few_substrings(spark):
    """Every occurrence, also of words of several bytes a character and in one long text; the work per place does not
    depend on where in its text it lies."""
    import random
    import time

    from featlab.operators.segmentation import dictionary_matches
    rng = random.Random(9)
    texts = [(k, "".join(rng.choice("aé漢😀 b") for _ in range(rng.choice([0, 3, 40, 700])))) for k in range(150)] + [(7, "aé漢"), (8, None), (None, "漢😀")]
    words = sorted({"".join(rng.choice("aé漢😀b") for _ in range(rng.randint(1, 5))) for _ in range(60)} | {""})
    df, d = spark.createDataFrame(texts, "id int, text string").repartition(3), spark.createDataFrame([(w,) for w in words + words[:5] + [None]], "word string")
    got = sorted(((-1 if r.id is None else r.id, r.start, r.word) for r in dictionary_matches(df, "id", "text", d).collect()))
    assert got == sorted((-1 if k is None else k, s + 1, w) for k, t in texts if t for w in words if w for s in range(len(t)) if t.startswith(w, s))
    assert dictionary_matches(df, "id", "text", d.limit(0)).count() == 0
    begun = time.time()
    long = spark.createDataFrame([(1, "xy zé" * 100_000 + "needle")], "id int, text string")
    assert [tuple(r) for r in dictionary_matches(long, "id", "text", spark.createDataFrame([("needle",)], "word string")).collect()] == [(1, 500_001, "needle")]
    assert time.time() - begun < 60
