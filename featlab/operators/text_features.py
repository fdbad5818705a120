"""Bag-of-words, n-grams, TF-IDF and keywords.

Documents stay in long/sparse form ``(doc, term, value)``; nothing is
densified. A document is one row, so its terms are counted inside the row
(Arrow batches, no shuffle); only rows whose id comes more than once are
added up by a shuffle. Per-term statistics are
aggregates keyed by term; joins back to the ``(doc, term)`` rows are left to
AQE (broadcast when the vocabulary is small, skew-split sort-merge when a
frequent term makes one key hot).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from featlab.functions.arrays import explode_values, posexplode_values
from featlab.functions.text import drop_words
from featlab.operators.ordering import global_rank, packed_dense_rank_ids
from featlab.session import written_table

#: Tokens of a counting step, and the repeated ids that are at most sent to all tasks.
STEP, REPEATED_IDS = 200_000, 100_000


def token_table(df: DataFrame, id_col: str, tokens: Column | str, pos_col: str = "pos",
                token_col: str = "token") -> DataFrame:
    """(id, pos, token) from an array column (order kept in ``pos``)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return (df.select(id_col, posexplode_values(t).alias(pos_col, token_col))
            .filter(F.col(token_col).isNotNull()))


def term_counts(df: DataFrame, tokens: Column | str, term_col: str = "term") -> DataFrame:
    """Corpus count per term."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return (df.select(explode_values(t).alias(term_col)).filter(F.col(term_col).isNotNull())
            .groupBy(term_col).agg(F.count(F.lit(1)).alias("count")))


def _dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal keys from 0, and the place of the first of each."""
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    return number, first


def _bucket_sums(row: np.ndarray, words: pa.Array, code: np.ndarray, count: np.ndarray, n_rows: int, n_features: int, signed: bool, l2: bool):
    """((rows, buckets), values): signed counts by md5 bucket; a word is hashed once."""
    texts = words.cast(pa.binary()).to_pylist()[:-1]
    bucket = np.array([int.from_bytes(hashlib.md5(w).digest()) % n_features for w in texts], np.int64)
    sign = np.array([-1.0 if signed and hashlib.md5(b"sign-" + w).digest()[-1] % 2 == 0 else 1.0 for w in texts])
    key, where = np.unique(row * n_features + bucket[code], return_inverse=True)
    value, at = np.bincount(where, sign[code] * count, len(key)), key // n_features
    if l2:
        with np.errstate(invalid="ignore"):
            value = value / np.sqrt(np.bincount(at, value * value, n_rows))[at]
    return (at, key % n_features), value


def _counted(n_min: int, n_max: int, hashed: tuple[int, bool, bool] | None = None):
    """Task: ``id, tokens`` rows to ``id, term, count, size``, the counted n-grams of every row, in steps of about ``STEP``
    tokens; with ``hashed`` (buckets, signed, l2) to ``id, bucket, value``, each row's words added up by bucket."""
    def step(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = part.column(1).flatten().dictionary_encode()
        if not len(coded):
            return
        words = pa.concat_arrays([coded.dictionary, pa.array([None], coded.dictionary.type)])
        code = pc.fill_null(coded.indices, len(words) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        row, left = np.repeat(np.arange(len(size)), size), np.repeat(np.cumsum(size), size) - np.arange(len(code))   # tokens from here to the row's end
        gram, number, starts = code, len(words), np.arange(len(code))
        for n in range(1, n_max + 1):
            if n > 1:   # the n-gram at a place: its first n - 1 tokens, then one more
                keep = left[starts] >= n
                starts, gram = starts[keep], gram[keep] * len(words) + code[starts[keep] + n - 1]
                if not len(starts):
                    return
                gram, first = _dense(gram)
                number = len(first)
            if n < n_min:
                continue
            key, first, count = np.unique(row[starts] * number + gram, return_index=True, return_counts=True)
            places = starts[first]
            if n == 1:
                known = code[places] < len(words) - 1
                places, count = places[known], count[known]
                term = words.take(pa.array(code[places]))
            else:
                term = pc.binary_join_element_wise(*[words.take(pa.array(code[places + i])) for i in range(n)], " ", null_handling="replace", null_replacement="null")
            at = row[places]
            if hashed:
                buckets, value = _bucket_sums(at, words, code[places], count, len(size), *hashed)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(buckets[0])), pa.array(buckets[1]), pa.array(value)], names=["id", "bucket", "value"])
                continue
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), term.cast(pa.string()), pa.array(count.astype(np.int64)), pa.array(size[at].astype(np.int32))],
                                             names=["id", "term", "count", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
                yield from step(b.slice(at, to - at))
                at = to
    return run


def doc_term_counts(df: DataFrame, id_col: str, tokens: Column | str, term_col: str = "term",
                    n_range: tuple[int, int] = (1, 1), size_col: str | None = None) -> DataFrame:
    """(id, term, count) per document, of its word n-grams; ``size_col`` adds
    the number of its tokens. Rows are counted one by one; of an id that several
    rows hold (rare, found by an aggregate of the ids alone) the counts are added."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    n_min, n_max = n_range
    schema = ST.StructType([ST.StructField("id", df.schema[id_col].dataType), ST.StructField("term", ST.StringType()),
                            ST.StructField("count", ST.LongType()), ST.StructField("size", ST.IntegerType())])
    names = [F.col("id").alias(id_col), F.col("term").alias(term_col), "count", *([F.col("size").alias(size_col)] if size_col else [])]

    def rows(part: DataFrame) -> DataFrame:
        return part.select(F.col(id_col).alias("id"), t.alias("tokens")).mapInArrow(_counted(n_min, n_max), schema)
    once, again = _by_repeats(df, id_col)
    if again is None:
        return rows(once).select(*names)
    added = rows(again).groupBy("id", "term").agg(F.sum("count").alias("count"), F.first("size").alias("size"))
    return rows(once).unionByName(added).select(*names)


def _by_repeats(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id comes once, and the others (None if there are none)."""
    again = df.groupBy(F.col(id_col).alias("_fl_again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_fl_again")
    found = again.limit(REPEATED_IDS + 1).count()
    if not found:
        return df, None
    again = F.broadcast(again) if found <= REPEATED_IDS else again
    same = F.col(id_col).eqNullSafe(F.col("_fl_again"))
    return df.join(again, same, "left_anti"), df.join(again, same, "left_semi")


def document_frequency(df: DataFrame, tokens: Column | str, term_col: str = "term") -> DataFrame:
    """(term, df): de-duplicated inside the row, so no (doc, term) shuffle."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return (df.select(explode_values(F.array_distinct(t)).alias(term_col))
            .filter(F.col(term_col).isNotNull())
            .groupBy(term_col).agg(F.count(F.lit(1)).alias("df")))


def top_terms(counts: DataFrame, k: int, term_col: str = "term", count_col: str = "count",
              reserve_zero: bool = False, id_col: str = "id") -> DataFrame:
    """The k most frequent terms (ties: term ascending), dense ids
    from 0, or from 1 when id 0 is reserved for padding/unknown."""
    w = Window.orderBy(F.col(count_col).desc(), F.col(term_col))
    # the top-k limit is the feature; Spark keeps only k rows per task before the final sort
    top = counts.orderBy(F.col(count_col).desc(), F.col(term_col)).limit(k)
    return top.withColumn(id_col, (F.row_number().over(w) - (0 if reserve_zero else 1)).cast("bigint"))


def ngram_frame(df: DataFrame, tokens_col: str, n_min: int = 1, n_max: int = 3,
                out_col: str = "ngrams") -> DataFrame:
    """Adds ``out_col`` with all word n-grams, n in [n_min, n_max], in the
    order (n, position). Uses MLlib's ``NGram`` (compiled JVM code, about
    twice as fast as the equivalent higher-order-function expression, see
    :func:`featlab.functions.text.ngrams` for a pure column version)."""
    from pyspark.ml.feature import NGram
    parts, out = [], df
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(F.col(tokens_col))
            continue
        c = f"_fl_ng{n}"
        out = NGram(n=n, inputCol=tokens_col, outputCol=c).transform(out)
        parts.append(F.col(c))
    res = out.withColumn(out_col, F.concat(*parts) if len(parts) > 1 else parts[0])
    return res.drop(*[f"_fl_ng{n}" for n in range(n_min, n_max + 1) if n > 1])


# ---- A21 / R04 / A30: n-gram bag of words --------------------------------------
@dataclass
class NGramBagModel:
    vocabulary: DataFrame          # term, term_id, df
    id_col: str
    n_range: tuple[int, int]
    stop_words: tuple[str, ...]

    def transform(self, df: DataFrame, tokens: Column) -> DataFrame:
        """Sparse counts (id, term_id, count) over the fitted vocabulary;
        terms outside it are dropped."""
        t = drop_words(tokens, self.stop_words) if self.stop_words else tokens
        counts = doc_term_counts(df, self.id_col, t, n_range=self.n_range)
        return counts.join(self.vocabulary.select("term", "term_id"), "term").select(self.id_col, "term_id", "term", "count")


class NGramBag:
    """Count vectorizer over word n-grams.

    ``min_df``/``max_df`` are document counts (int) or shares (float);
    ``max_features`` keeps the most frequent terms; ids are alphabetical
    over the kept vocabulary (the usual count-vectorizer convention).
    """

    def __init__(self, id_col: str, n_range=(1, 3), stop_words: Sequence[str] = (),
                 min_df=1, max_df=1.0, max_features: int | None = None,
                 vocabulary: DataFrame | None = None, single_pass: bool = True):
        self.id_col = id_col
        self.single_pass = single_pass
        self.n_range = tuple(n_range)
        self.stop_words = tuple(stop_words)
        self.min_df, self.max_df = min_df, max_df
        self.max_features = max_features
        self.fixed_vocab = vocabulary

    def fit_counts(self, df: DataFrame, tokens: Column) -> tuple[NGramBagModel, DataFrame]:
        """Fit and return the model plus the sparse (id, term, count) rows
        over its vocabulary."""
        t = drop_words(tokens, self.stop_words) if self.stop_words else tokens
        counts = doc_term_counts(df, self.id_col, t, n_range=self.n_range)
        unfiltered = (self.single_pass and self.fixed_vocab is None and self.max_features is None
                      and self.min_df in (0, 0.0, 1) and self.max_df in (1.0,))
        if unfiltered:
            # every term is kept: alphabetical ids in one range pass over the
            # (doc, term) rows, no separate vocabulary rank and join
            rows = packed_dense_rank_ids(counts.select(self.id_col, "term", "count"), "term", F.xxhash64(self.id_col), "term_id")
            vocab = rows.groupBy("term_id", "term").agg(F.count(F.lit(1)).alias("df"))
            model = NGramBagModel(vocab.select("term", "term_id", "df"), self.id_col, self.n_range,
                                  self.stop_words)
            return model, rows.select(self.id_col, "term_id", "term", "count")
        if not self.max_features:
            # fit (vocabulary) and transform (rows) both read the counts: written once. With a bounded
            # vocabulary few rows are left, which counting again gives without a copy of all counts.
            counts = written_table(counts)
        stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("count").alias("tf"))
        if self.fixed_vocab is not None:
            stats = stats.join(self.fixed_vocab.select("term"), "term")
        n_docs = None
        if isinstance(self.min_df, float) or isinstance(self.max_df, float):
            n_docs = df.count()
        lo = self.min_df if isinstance(self.min_df, int) else self.min_df * n_docs
        hi = self.max_df if isinstance(self.max_df, int) else self.max_df * n_docs
        if lo > 1 or isinstance(self.min_df, float):
            stats = stats.filter(F.col("df") >= F.lit(lo))
        if isinstance(self.max_df, int) or self.max_df < 1.0:
            stats = stats.filter(F.col("df") <= F.lit(hi))
        if self.max_features:
            stats = stats.orderBy(F.col("tf").desc(), F.col("term")).limit(self.max_features)
        vocab = global_rank(stats, [F.col("term")], "term_id")
        vocab = vocab.withColumn("term_id", (F.col("term_id") - 1).cast("bigint"))
        model = NGramBagModel(vocab.select("term", "term_id", "df"), self.id_col, self.n_range,
                              self.stop_words)
        rows = counts.join(vocab.select("term", "term_id"), "term")
        return model, rows.select(self.id_col, "term_id", "term", "count")


# ---- A18 / A19 / A20: TF-IDF ------------------------------------------------------
def idf_table(df: DataFrame, tokens: Column | str, smooth: bool = True, n_docs: int | None = None,
              term_col: str = "term") -> DataFrame:
    """Smoothed idf = ln((1 + N) / (1 + df)) + 1, or ln(N / df) + 1."""
    n = n_docs if n_docs is not None else df.count()
    d = document_frequency(df, tokens, term_col)
    idf = (F.log((F.lit(1.0 + n)) / (1.0 + F.col("df"))) + 1.0) if smooth else (F.log(F.lit(float(n)) / F.col("df")) + 1.0)
    return d.withColumn("idf", idf)


def tfidf(df: DataFrame, id_col: str, tokens: Column | str, norm: str | None = "l2",
          smooth_idf: bool = True, sublinear_tf: bool = False, use_idf: bool = True) -> DataFrame:
    """(id, term, value) with optional 1 + ln(tf) and L1/L2 row norm.
    The row norm is a window per document (bounded by its distinct terms)."""
    counts = doc_term_counts(df, id_col, tokens)
    tf = (1.0 + F.log(F.col("count"))) if sublinear_tf else F.col("count").cast("double")
    if use_idf:
        # counts are read twice (rows and document frequencies): tokenised once, written once
        counts = written_table(counts)
        n = float(df.count())
        dfreq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weight = (F.log((1.0 + n) / (1.0 + F.col("df"))) if smooth_idf else F.log(n / F.col("df"))) + 1.0
        v = counts.join(dfreq.select("term", weight.alias("idf")), "term").withColumn("value", tf * F.col("idf"))
    else:
        v = counts.withColumn("value", tf)
    wd = Window.partitionBy(id_col)
    if norm == "l2":
        v = v.withColumn("value", F.col("value") / F.sqrt(F.sum(F.col("value") * F.col("value")).over(wd)))
    elif norm == "l1":
        v = v.withColumn("value", F.col("value") / F.sum(F.abs("value")).over(wd))
    return v.select(id_col, "term", "count", "value")


def keyword_idf(df: DataFrame, tokens: Column | str, term_col: str = "term") -> tuple[DataFrame, int]:
    """A18 (keyword flavour): idf = ln(N / (1 + df)); unseen terms get ln(N)."""
    n = df.count()
    d = document_frequency(df, tokens, term_col)
    return d.withColumn("idf", F.log(F.lit(float(n)) / (1.0 + F.col("df")))), n


def tfidf_keywords(df: DataFrame, id_col: str, tokens: Column | str, k: int = 10,
                   idf: DataFrame | None = None, n_docs: int | None = None) -> DataFrame:
    """Per document, tf = count / document length, score = tf * idf,
    top-k by score desc, ties by term desc (R03). ``idf`` defaults to the
    one trained on the same documents."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    counts = doc_term_counts(df, id_col, t, size_col="_fl_len")
    if idf is None:
        # df = number of (doc, term) rows per term: an aggregate of the counts, which are
        # written once so that the corpus is tokenised once; N is a lazy one-row statistic
        from featlab.operators.stats import attach_row
        counts = written_table(counts)
        n = df.agg(F.count(F.lit(1)).cast("double").alias("_fl_n"))
        dfreq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = attach_row(dfreq, n).withColumn("idf", F.log(F.col("_fl_n") / (1.0 + F.col("df")))).drop("_fl_n")
    default_idf = F.log(F.lit(float(n_docs))) if n_docs else F.lit(None)
    scored = (counts.join(idf.select("term", "idf"), "term", "left")
              .withColumn("score", (F.col("count") / F.col("_fl_len")) * F.coalesce(F.col("idf"), default_idf)))
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("term").desc())
    return (scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(id_col, "rank", "term", "score"))


# ---- C04 / C05 in table form ----------------------------------------------------------------
def setdiff_positions(values: DataFrame, remove: DataFrame, value_col: str, pos_col: str = "pos") -> DataFrame:
    """Rows of ``values`` whose value is not in ``remove``, keeping
    their positions (duplicates kept, unlike ``array_except``)."""
    return values.join(remove.select(value_col).distinct(), value_col, "left_anti")


def unique_with_index(df: DataFrame, group_cols: Sequence[str], pos_col: str, value_col: str,
                      idx_col: str = "idx") -> DataFrame:
    """Per group, distinct values in first-seen order (index 0, 1, ...)
    and the index of every input row. The window runs over the group's
    distinct values only (first positions), not over its rows."""
    first = df.groupBy(*group_cols, value_col).agg(F.min(pos_col).alias("_fl_first"))
    w = Window.partitionBy(*group_cols).orderBy("_fl_first")
    ids = first.withColumn(idx_col, (F.row_number().over(w) - 1).cast("int"))
    return df.join(ids.select(*group_cols, value_col, idx_col), [*group_cols, value_col])


# ---- E07: hashed vectors ----------------------------------------------------------------------
def hashed_vectors(df: DataFrame, id_col: str, tokens: Column | str, n_features: int = 1 << 20,
                   signed: bool = True, l2: bool = True) -> DataFrame:
    """Sparse long form (id, bucket, value) of signed feature hashing
    (md5 buckets, sign from an independent hash), optionally L2-normalised
    per row. MLlib ``HashingTF`` is the unsigned fast path."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    schema = ST.StructType([ST.StructField("id", df.schema[id_col].dataType), ST.StructField("bucket", ST.LongType()), ST.StructField("value", ST.DoubleType())])

    def rows(part: DataFrame, norm: bool) -> DataFrame:
        return part.select(F.col(id_col).alias("id"), t.alias("tokens")).mapInArrow(_counted(1, 1, (n_features, signed, norm)), schema)
    once, again = _by_repeats(df, id_col)
    out = rows(once, l2)
    if again is not None:   # the rows of an id are added up before its norm
        added = rows(again, False).groupBy("id", "bucket").agg(F.sum("value").alias("value"))
        if l2:
            added = added.withColumn("value", F.col("value") / F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("id"))))
        out = out.unionByName(added)
    return out.select(F.col("id").alias(id_col), "bucket", "value")
