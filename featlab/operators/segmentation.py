"""Dictionary-driven token work.

Dictionaries stay tables: ``dictionary_matches`` finds the words that occur in a
text by an equi-join on the substrings that may be words, and everything else
works on a text's own matches. Work is done once per *distinct* token or text (``distinct`` is a
shuffle whose size follows the vocabulary, not the corpus) and joined back to
the rows. Of a dictionary only a bitmap of bounded size is broadcast, so it has no size limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

#: Characters by which longer words are found, and text bytes that are searched together.
PLACE, STEP = 32, 1 << 18
#: A bitmap has 1024 bits per word, up to so many (16 MB).
MOST_BITS = 1 << 27

#: Hash of the bytes i .. j - 1: the sum of their numbers times the powers of an odd base (modulo 2^64), divided by the power at i.
_NUMBER = np.random.default_rng(8).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each starts and the last ends); NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class _Hashes:
    """Hashes of all substrings of ``data``."""

    def __init__(self, data: np.ndarray):
        power = np.full(len(data) + 1, _BASE)
        inverse = np.full(len(data) + 1, _INVERSE)
        power[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_NUMBER[data] * np.cumprod(power, dtype=np.uint64)[:-1], dtype=np.uint64)])

    def places(self, starts: np.ndarray, sizes: np.ndarray | int, bits: int) -> np.ndarray:
        """Place in a bitmap of ``bits`` (a power of two) of the substrings at ``starts``."""
        h = (self.sums[starts + sizes] - self.sums[starts]) * self.inverse[starts]
        h = (h ^ (h >> np.uint64(32))) * _NUMBER[7]
        return ((h >> np.uint64(24)) & np.uint64(bits - 1)).astype(np.int64)


def _bitmap(words: DataFrame, n: int) -> np.ndarray:
    """Bits of the hashes of ``_w``, a table of ``n`` words."""
    bits = min(MOST_BITS, 1 << max(16, (1024 * n - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, ends = _bytes_of(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(_Hashes(data).places(ends[:-1], np.diff(ends), bits) + 1)], names=["place"])
    found = np.zeros(bits // 8, np.uint8)
    part = words.select("_w").mapInArrow(run, "place long").groupBy(F.bitmap_bucket_number("place").alias("k")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    for k, some in part.toLocalIterator():   # 4 KB a row, ``bits`` in all
        found[(k - 1) * 4096:(k - 1) * 4096 + len(some)] = np.frombuffer(some, np.uint8)
    return found


# ---- J08: every dictionary word in a text --------------------------------------------------
def dictionary_matches(df: DataFrame, id_col: str, text_col: str, dictionary: DataFrame,
                       word_col: str = "word") -> DataFrame:
    """J08 (full mode): every dictionary word occurring in the text, with
    its 1-based start: (id, start, word).

    Tasks hash, for every length that words have, the substrings of their texts
    and pass on those whose hash is in a bitmap of the words' hashes (bounded;
    a false hit costs a row). These are then joined with the dictionary. Words
    longer than ``PLACE`` characters are found by their first ``PLACE`` and
    compared with the text itself."""
    every = dictionary.select(F.col(word_col).alias("_w")).filter(F.length("_w") > 0).distinct()
    head = F.substring("_w", 1, PLACE)
    heads = every.select(head.alias("_w"))
    longest, n, sizes = every.agg(F.max(F.length("_w")), F.count("_w"), F.array_sort(F.collect_set(F.octet_length(head)))).first()
    schema = ST.StructType([ST.StructField("id", df.schema[id_col].dataType), ST.StructField("start", ST.IntegerType()), ST.StructField("_w", ST.StringType())])
    spark = df.sparkSession
    bitmap = spark.sparkContext.broadcast(_bitmap(heads, n))

    def found_in(ids: pa.Array, column: pa.Array) -> pa.RecordBatch:
        table = bitmap.value
        data, ends = _bytes_of(column)
        hashes = _Hashes(data)
        at = np.flatnonzero((data & 0xC0) != 0x80)   # bytes where a character starts
        row = np.searchsorted(ends, at, "right") - 1
        left = ends[row + 1] - at
        number = np.arange(len(at)) - np.searchsorted(at, ends[row]) + 1
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        live = np.arange(len(at))
        for size in sizes:
            live = live[left[live] >= size]
            place = hashes.places(at[live], size, 8 * len(table))
            hit = live[(table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)]
            hits.append((hit, np.full(len(hit), size)))
        hit, size = np.concatenate([h for h, _ in hits]), np.concatenate([k for _, k in hits])
        text = data.tobytes()
        words = pa.array([text[a:a + k] for a, k in zip(at[hit].tolist(), size.tolist())], pa.binary())
        return pa.RecordBatch.from_arrays([ids.take(pa.array(row[hit])), pa.array(number[hit].astype(np.int32)), words.view(pa.string())], names=["id", "start", "_w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < b.num_rows and sizes:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
                yield found_in(b.column(0).slice(at, to - at), b.column(1).slice(at, to - at))
                at = to

    found = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
    words = every.filter(F.length("_w") <= PLACE)
    matches = found.join(words, "_w").select(id_col, "start", F.col("_w").alias(word_col))
    if (longest or 0) <= PLACE:
        return matches
    long = every.filter(F.length("_w") > PLACE).select("_w", head.alias("_s"))
    maybe = found.withColumnRenamed("_w", "_s").join(long, "_s").select(F.col(id_col).alias("_id"), "start", "_w").distinct()
    whole = df.join(maybe, df[id_col].eqNullSafe(F.col("_id"))).filter(F.substring(F.col(text_col), F.col("start"), F.length("_w")) == F.col("_w"))
    return matches.unionByName(whole.select(id_col, "start", F.col("_w").alias(word_col)))


# ---- X08: WordPiece -------------------------------------------------------------------
def wordpiece_tokens(tokens: DataFrame, token_col: str, vocab: DataFrame, vocab_col: str = "token",
                     unk: str = "[UNK]", max_chars: int = 100) -> DataFrame:
    """Add ``pieces`` (array<string>) to every token row: from the left, the
    longest vocabulary entry that fits (entries inside a token carry ``##``);
    ``unk`` if some part has none or the token is longer than ``max_chars``."""
    inner = F.col(vocab_col).startswith("##")
    bodies = vocab.select(F.when(inner, F.substring(vocab_col, 3, 1 << 30)).otherwise(F.col(vocab_col)).alias("_body"), inner.alias("_inner"))
    # an entry that itself begins with ## can also start a token
    bodies = bodies.unionByName(vocab.filter(inner).select(F.col(vocab_col).alias("_body"), F.lit(False).alias("_inner"))).distinct()
    distinct = tokens.select(F.col(token_col).alias("_tok")).filter(F.col("_tok").isNotNull()).distinct()
    fits = dictionary_matches(distinct.filter(F.length("_tok") <= max_chars).withColumn("_text", F.col("_tok")), "_tok", "_text", bodies, "_body") \
        .join(bodies, "_body").filter(F.col("_inner") == (F.col("start") > 1))
    longest = fits.groupBy("_tok", "start").agg(F.max(F.length("_body")).alias("n")).groupBy("_tok") \
        .agg(F.map_from_entries(F.collect_list(F.struct("start", "n"))).alias("_fit"))
    n = F.length("_tok")

    def step(done, place):
        """``done``: the next place to fill and the pieces so far; other places pass by."""
        size = F.col("_fit")[place]
        body = F.substring(F.col("_tok"), place, size)
        piece = F.when(place > 1, F.concat(F.lit("##"), body)).otherwise(body)
        here = (done["next"] == place) & size.isNotNull()
        return F.struct(F.when(here, place + size).otherwise(done["next"]).alias("next"),
                        F.when(here, F.concat(done["pieces"], F.array(piece))).otherwise(done["pieces"]).alias("pieces"))
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("pieces"))
    walk = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step)
    pieces = distinct.join(longest, "_tok", "left").withColumn("_walk", F.when(F.col("_fit").isNotNull(), walk)) \
        .select("_tok", F.when(n == 0, F.array().cast("array<string>")).when(F.col("_walk.next") == n + 1, F.col("_walk.pieces"))
                .otherwise(F.array(F.lit(unk))).alias("pieces"))
    return tokens.join(pieces, tokens[token_col] == pieces["_tok"], "left").drop("_tok")


# ---- X14: Porter stemmer (Porter 1980, original rules) -----------------------------------
def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in "aeiou":
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem: str) -> int:
    """Number of VC sequences in the stem."""
    n, i, L = 0, 0, len(stem)
    while i < L and _cons(stem, i):
        i += 1
    while i < L:
        while i < L and not _cons(stem, i):
            i += 1
        if i >= L:
            break
        n += 1
        while i < L and _cons(stem, i):
            i += 1
    return n


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_c(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return (len(w) >= 3 and _cons(w, len(w) - 3) and not _cons(w, len(w) - 2)
            and _cons(w, len(w) - 1) and w[-1] not in "wxy")


# fixed suffix tables of the published algorithm (steps 2, 3 and 4)
_STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", ""))
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
          "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def porter_stem(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    flag = False
    if w.endswith("eed"):
        if _m(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, flag = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, flag = w[:-3], True
    if flag:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_c(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _m(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # steps 2 and 3
    for table in (_STEP2, _STEP3):
        for suf, rep in table:
            if w.endswith(suf):
                if _m(w[:-len(suf)]) > 0:
                    w = w[:-len(suf)] + rep
                break
    # step 4
    for suf in _STEP4:
        if w.endswith(suf):
            stem = w[:-len(suf)]
            if _m(stem) > 1 and (suf != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    # step 5
    if w.endswith("e"):
        stem = w[:-1]
        if _m(stem) > 1 or (_m(stem) == 1 and not _cvc(stem)):
            w = stem
    if _m(w) > 1 and _double_c(w) and w.endswith("l"):
        w = w[:-1]
    return w


def stems(tokens: DataFrame, token_col: str, out_col: str = "stem") -> DataFrame:
    """Stem each distinct token once, join back."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({token_col: pdf[token_col], out_col: pdf[token_col].map(porter_stem)})
    d = tokens.select(token_col).distinct().mapInPandas(run, f"{token_col} string, {out_col} string")
    return tokens.join(d, token_col, "left")


# ---- X11-X13: dictionary segmentation ------------------------------------------------------
def best_path(text: str, matches: list[tuple[int, int, float]], total: float) -> list[str]:
    """Most probable split of ``text`` given its own dictionary matches
    (0-based start, length, frequency); a character alone counts as frequency
    1 if the dictionary lacks it. Of equal paths the longer first word wins."""
    n = len(text)
    options: list[dict[int, float]] = [{1: 1.0} for _ in range(n)]
    for start, length, freq in matches:
        options[start][length] = freq or 1.0
    score, width = [0.0] * (n + 1), [0] * n
    for i in reversed(range(n)):
        score[i], width[i] = max((math.log(f / total) + score[i + k], k) for k, f in options[i].items())
    out, i = [], 0
    while i < n:
        out.append(text[i:i + width[i]])
        i += width[i]
    return out


def segment_text(df: DataFrame, text_col: str, dictionary: DataFrame, word_col: str = "word",
                 freq_col: str = "freq", search_mode: bool = False) -> DataFrame:
    """X11 (precise) / X12 (search: adds in-dictionary 2- and 3-char parts
    of longer words): ``words`` array per distinct text, joined back. NULL
    texts get no words."""
    d = dictionary.select(F.col(word_col).alias("_word"), F.coalesce(F.col(freq_col), F.lit(1)).cast("double").alias("_f"))
    total = float(d.agg(F.sum("_f")).first()[0] or 1)
    texts = df.select(F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    found = dictionary_matches(texts.withColumn("_body", F.col("_text")), "_text", "_body", d, "_word").join(d, "_word") \
        .groupBy("_text").agg(F.collect_list(F.struct((F.col("start") - 1).alias("s"), F.length("_word").alias("n"), "_f")).alias("_found"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            words = []
            for text, found in zip(pdf["_text"], pdf["_found"]):
                matches = [(m["s"], m["n"], m["_f"]) for m in (found if found is not None else [])]
                path = best_path(text, matches, total)
                if search_mode:
                    known = {(s, n) for s, n, _ in matches}
                    parts, at = [], 0
                    for w in path:
                        parts += [text[i:i + k] for k in (2, 3) if len(w) > k for i in range(at, at + len(w) - k + 1) if (i, k) in known]
                        at += len(w)
                    path = parts + path
                words.append(path)
            yield pd.DataFrame({"_text": pdf["_text"], "words": words})

    seg = texts.join(found, "_text", "left").mapInPandas(run, "_text string, words array<string>")
    return df.join(seg, df[text_col] == seg["_text"], "left").drop("_text")


def suggest_freq(dictionary: DataFrame, word: str, parts: list[str] | None = None,
                 word_col: str = "word", freq_col: str = "freq") -> DataFrame:
    """Tune one dictionary entry so the wanted split wins. Keep ``word``
    whole: its frequency becomes at least one above the product of its best
    path, never less than it is. Break it into ``parts``: at most that
    product, never more than it is."""
    spark = dictionary.sparkSession
    total = float(dictionary.agg(F.sum(freq_col)).first()[0] or 1)
    pieces = parts if parts is not None else segment_text(spark.createDataFrame([(word,)], "t string"), "t", dictionary, word_col, freq_col).first()["words"]
    known = {r[0]: r[1] for r in dictionary.filter(F.col(word_col).isin([*pieces, word])).select(word_col, freq_col).collect()}  # the word's own pieces
    product = math.prod((known.get(p) or 1) / total for p in pieces) * total
    now = known.get(word) or 0
    new = max(int(product) + 1, now) if parts is None else min(int(product), now)
    kept = dictionary.filter(~F.col(word_col).eqNullSafe(F.lit(word)))
    entry = spark.createDataFrame([(word, new)], f"{word_col} string, {freq_col} bigint")
    return kept.unionByName(entry, allowMissingColumns=True)


# ---- J09, J10 ------------------------------------------------------------------------------
def tag_tokens(tokens: DataFrame, token_col: str, tags: DataFrame, word_col: str = "word",
               tag_col: str = "tag", default: str = "x") -> DataFrame:
    """Part-of-speech (or any) tag from a dictionary, default ``x``."""
    t = tags.select(F.col(word_col).alias(token_col), F.col(tag_col).alias("tag"))
    return tokens.join(t, token_col, "left").withColumn("tag", F.coalesce("tag", F.lit(default)))


def lemmatize(tokens: DataFrame, token_col: str, lemmas: DataFrame, form_col: str = "form",
              lemma_col: str = "lemma") -> DataFrame:
    """Lemma from a (form, lemma) table, the token itself otherwise."""
    t = lemmas.select(F.col(form_col).alias(token_col), F.col(lemma_col).alias("_fl_lemma"))
    return (tokens.join(t, token_col, "left")
            .withColumn("lemma", F.coalesce("_fl_lemma", F.col(token_col))).drop("_fl_lemma"))


# ---- X09: full and char tokenizers ------------------------------------------------------------
def full_tokenize(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame, vocab_col: str = "token",
                  id_vocab_col: str = "id", lower: bool = True) -> DataFrame:
    """Basic tokens -> WordPiece pieces -> ids (inner lookup keeps the
    pieces found in the vocabulary, order by (token position, piece)).
    Returns (id, pos, sub, piece, piece_id)."""
    from featlab.functions.arrays import posexplode_values
    from featlab.functions.text import basic_tokens
    toks = (df.select(id_col, posexplode_values(basic_tokens(text_col, lower=lower)).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))
    pieces = wordpiece_tokens(toks, "token", vocab, vocab_col)
    flat = pieces.select(id_col, "pos", F.posexplode("pieces").alias("sub", "piece"))
    ids = vocab.select(F.col(vocab_col).alias("piece"), F.col(id_vocab_col).alias("piece_id"))
    return flat.join(ids, "piece")


def char_tokenize(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame, vocab_col: str = "token") -> DataFrame:
    """X09 CharTokenizer: lower-case, split on single blanks, WordPiece."""
    from featlab.functions.arrays import posexplode_values
    toks = (df.select(id_col, posexplode_values(F.split(F.lower(text_col), " ")).alias("pos", "token"))
            .filter(F.col("token").isNotNull() & (F.col("token") != "")))
    return wordpiece_tokens(toks, "token", vocab, vocab_col)
