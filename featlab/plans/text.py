"""Queries over ``documents`` / ``pages`` / ``benchmark`` (text operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.functions import text as T
from featlab.functions.arrays import explode_values, posexplode_values
from featlab.functions.hashing import md5_mod
from featlab.operators import text_features as TF
from featlab.plans.registry import md5_mod_sql, query
from featlab.sources.tables import read_table, spread

R = 6

# Stop words used by the keyword queries: a short list of frequent function
# words of the corpus languages (a query parameter, not learned data).
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is",
              "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
              "der", "die", "das", "und", "le", "la", "les", "et", "el", "los", "y", "de")

WORD_RE = r"[\p{L}\p{N}_]+"
_SQL_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_SQL_TOK = f"regexp_extract_all(lower(text), '{WORD_RE}')"
_SQL_KW_TOK = f"list_filter({_SQL_TOK}, lambda x: length(x) > 1 AND NOT list_contains({_SQL_STOP}, x))"


def _docs(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def keyword_tokens(text_col):
    return T.drop_words(T.drop_short(T.word_tokens(text_col), 2), STOP_WORDS)


# ---- A21: n-gram bag of words ----------------------------------------------------
@query("a21_ngram_bag_of_words", f"""
WITH t AS (SELECT doc_id, {_SQL_TOK} AS tok FROM documents),
g AS (SELECT doc_id, array_to_string(list_slice(tok, i, i + n - 1), ' ') AS term
      FROM (SELECT doc_id, tok, n, unnest(generate_series(1, len(tok) - n + 1)) AS i
            FROM t, (VALUES (1), (2), (3)) v(n))),
c AS (SELECT doc_id, term, count(*) AS count FROM g GROUP BY 1, 2),
v AS (SELECT term, dense_rank() OVER (ORDER BY term) - 1 AS term_id FROM (SELECT DISTINCT term FROM c))
SELECT doc_id, term_id, term, count FROM c JOIN v USING (term)
""")
def a21_ngram_bag_of_words(spark, sf_dir):
    _, rows = TF.NGramBag("doc_id", (1, 3)).fit_counts(_docs(spark, sf_dir), T.word_tokens("text"))
    return rows


# ---- X16: TF-IDF keywords, top 10 per document ----------------------------------------
@query("x16_tfidf_keywords", f"""
WITH t AS (SELECT doc_id, {_SQL_KW_TOK} AS tok FROM documents),
n AS (SELECT count(*) AS n FROM t),
d AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(tok) AS term FROM t) GROUP BY term),
c AS (SELECT doc_id, term, count(*) AS cnt, any_value(l) AS l
      FROM (SELECT doc_id, len(tok) AS l, unnest(tok) AS term FROM t) GROUP BY 1, 2),
s AS (SELECT doc_id, term, (cnt / l) * ln(n.n / (1.0 + df)) AS score FROM c JOIN d USING (term), n),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term DESC) AS rank FROM s)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, round(score, 6) AS score FROM r WHERE rank <= 10
""")
def x16_tfidf_keywords(spark, sf_dir):
    kw = TF.tfidf_keywords(_docs(spark, sf_dir), "doc_id", keyword_tokens("text"), k=10)
    return kw.select("doc_id", "rank", "term", F.round("score", R).alias("score"))


# ---- A17 / A18 / A19 / A20 ----------------------------------------------------------------
@query("a17_term_counts", f"""
SELECT term, count(*) AS count FROM (SELECT unnest({_SQL_TOK}) AS term FROM documents) GROUP BY term
""")
def a17_term_counts(spark, sf_dir):
    return TF.term_counts(_docs(spark, sf_dir), T.word_tokens("text"))


@query("a18_keyword_idf", f"""
WITH t AS (SELECT doc_id, {_SQL_KW_TOK} AS tok FROM documents)
SELECT term, count(*) AS df, round(ln((SELECT count(*) FROM t) / (1.0 + count(*))), 6) AS idf
FROM (SELECT DISTINCT doc_id, unnest(tok) AS term FROM t) GROUP BY term
""")
def a18_keyword_idf(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(keyword_tokens("text").alias("tok"))
    idf, _ = TF.keyword_idf(docs, "tok")
    return idf.select("term", "df", F.round("idf", R).alias("idf"))


@query("a19_term_frequency", f"""
WITH t AS (SELECT doc_id, {_SQL_KW_TOK} AS tok FROM documents)
SELECT doc_id, term, count(*) AS count, round(count(*) / any_value(l), 6) AS tf
FROM (SELECT doc_id, len(tok) AS l, unnest(tok) AS term FROM t) GROUP BY doc_id, term
""")
def a19_term_frequency(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", keyword_tokens("text").alias("tok"))
    c = (docs.select("doc_id", F.size("tok").alias("l"), explode_values("tok").alias("term"))
         .filter(F.col("term").isNotNull())
         .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("count"), F.first("l").alias("l")))
    return c.select("doc_id", "term", "count", F.round(F.col("count") / F.col("l"), R).alias("tf"))


@query("a20_tfidf_l2", f"""
WITH t AS (SELECT doc_id, {_SQL_TOK} AS tok FROM documents),
n AS (SELECT count(*) AS n FROM t),
d AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(tok) AS term FROM t) GROUP BY term),
c AS (SELECT doc_id, term, count(*) AS count FROM (SELECT doc_id, unnest(tok) AS term FROM t) GROUP BY 1, 2),
v AS (SELECT doc_id, term, count, count * (ln((1.0 + n.n) / (1.0 + df)) + 1.0) AS value FROM c JOIN d USING (term), n)
SELECT doc_id, term, count, round(value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)), 6) AS value FROM v
""")
def a20_tfidf_l2(spark, sf_dir):
    v = TF.tfidf(_docs(spark, sf_dir), "doc_id", T.word_tokens("text"), norm="l2", smooth_idf=True)
    return v.select("doc_id", "term", "count", F.round("value", R).alias("value"))


# ---- R01: vocabulary of the 999 most frequent terms, id 0 reserved ---------------------------
@query("r01_top_vocabulary", f"""
WITH c AS (SELECT term, count(*) AS count FROM (SELECT unnest({_SQL_TOK}) AS term FROM documents) GROUP BY term)
SELECT term, count, row_number() OVER (ORDER BY count DESC, term) AS id
FROM c ORDER BY count DESC, term LIMIT 999
""")
def r01_top_vocabulary(spark, sf_dir):
    counts = TF.term_counts(_docs(spark, sf_dir), T.word_tokens("text"))
    return TF.top_terms(counts, 999, reserve_zero=True).select("term", "count", "id")


# ---- X01-X07 tokenizers, whole texts -----------------------------------------------------
@query("x01_clean_text", r"""
SELECT doc_id, regexp_replace(regexp_replace(text, '[\t\n\r\p{Zs}]', ' ', 'g'), '[\x{0}\x{FFFD}\p{C}]', '', 'g') AS clean
FROM documents
""")
def x01_clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.clean_text("text").alias("clean"))


@query("x05_word_tokens", f"""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, tok[pos] AS token
FROM (SELECT doc_id, tok, unnest(generate_series(1, len(tok))) AS pos
      FROM (SELECT doc_id, {_SQL_TOK} AS tok FROM documents))
""")
def x05_word_tokens(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return (d.select("doc_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()).withColumn("pos", (F.col("pos") + 1).cast("int")))


@query("x06_whitespace_tokens", r"""
SELECT page_id, count(*) AS n_tokens, CAST(sum(length(t)) AS BIGINT) AS n_chars
FROM (SELECT page_id, unnest(regexp_split_to_array(trim(html), '[\s\p{Z}]+')) AS t FROM pages)
WHERE t <> '' GROUP BY page_id
""")
def x06_whitespace_tokens(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", "page_id", "html")
    toks = p.select("page_id", explode_values(T.whitespace_tokens("html")).alias("t")) \
        .filter(F.col("t").isNotNull())
    return toks.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                       F.sum(F.length("t")).cast("bigint").alias("n_chars"))


@query("x07_basic_tokens", r"""
WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(text, '[\t\n\r\p{Zs}]', ' ', 'g'), '[\x{0}\x{FFFD}\p{C}]', '', 'g') AS t FROM documents),
p AS (SELECT doc_id, regexp_replace(strip_accents(lower(t)), '([\p{P}!-/:-@\[-`{-~])', ' \1 ', 'g') AS t FROM c),
s AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(t), '[\s\p{Z}]+'), lambda x: x <> '') AS tok FROM p)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, tok[pos] AS token
FROM (SELECT doc_id, tok, unnest(generate_series(1, len(tok))) AS pos FROM s)
""")
def x07_basic_tokens(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return (d.select("doc_id", posexplode_values(T.basic_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()).withColumn("pos", (F.col("pos") + 1).cast("int")))


# ---- P10 / P11 / J04: token checks and stop-word removal -----------------------------------
@query("p10_token_checks", r"""
SELECT t AS token, count(*) AS count,
       regexp_matches(t, '\p{Nd}') AS has_numbers, regexp_matches(t, '^[^\p{L}\p{N}_]') AS is_symbol
FROM (SELECT unnest(regexp_split_to_array(trim(text), '[\s\p{Z}]+')) AS t FROM benchmark)
WHERE t <> '' GROUP BY t
""")
def p10_token_checks(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "text")
    toks = b.select(explode_values(T.whitespace_tokens("text")).alias("token")) \
        .filter(F.col("token").isNotNull())
    return (toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
            .select("token", "count", T.has_numbers("token").alias("has_numbers"),
                    T.is_symbol("token").alias("is_symbol")))


@query("j04_stopword_filter", f"""
SELECT doc_id, count(*) AS kept, count(DISTINCT t) AS distinct_kept
FROM (SELECT doc_id, unnest({_SQL_KW_TOK}) AS t FROM documents) GROUP BY doc_id
""")
def j04_stopword_filter(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", explode_values(keyword_tokens("text")).alias("t")) \
        .filter(F.col("t").isNotNull())
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"),
                                   F.countDistinct("t").alias("distinct_kept"))


# ---- E04 / E05: feature hashing of word tokens (md5 buckets) --------------------------------


@query("e04_hashed_counts", f"""
SELECT doc_id, CAST({md5_mod_sql('t', 1024)} AS BIGINT) AS bucket, count(*) AS count
FROM (SELECT doc_id, unnest({_SQL_TOK}) AS t FROM documents) GROUP BY 1, 2
""")
def e04_hashed_counts(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", explode_values(T.word_tokens("text")).alias("t")) \
        .filter(F.col("t").isNotNull())
    return d.groupBy("doc_id", md5_mod(F.col("t"), 1024).alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


@query("e05_signed_hashed_counts", f"""
SELECT doc_id, CAST({md5_mod_sql('t', 1024)} AS BIGINT) AS bucket,
       CAST(sum(CASE WHEN {md5_mod_sql("'sign-' || t", 2)} = 0 THEN -1 ELSE 1 END) AS BIGINT) AS value
FROM (SELECT doc_id, unnest({_SQL_TOK}) AS t FROM documents) GROUP BY 1, 2
""")
def e05_signed_hashed_counts(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", explode_values(T.word_tokens("text")).alias("t")) \
        .filter(F.col("t").isNotNull())
    sign = F.when(md5_mod(F.concat(F.lit("sign-"), F.col("t")), 2) == 0, -1).otherwise(1)
    return d.groupBy("doc_id", md5_mod(F.col("t"), 1024).alias("bucket")).agg(F.sum(sign).alias("value"))


# ---- C04 / C05 / E07 ---------------------------------------------------------------------------
def _bench_tokens(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return (b.select("item_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))


_SQL_BENCH_TOK = f"""SELECT item_id, CAST(pos - 1 AS INTEGER) AS pos, tok[pos] AS token
  FROM (SELECT item_id, tok, unnest(generate_series(1, len(tok))) AS pos
        FROM (SELECT item_id, {_SQL_TOK} AS tok FROM benchmark))"""


@query("c04_setdiff_positions", f"""
SELECT item_id, pos, token FROM ({_SQL_BENCH_TOK}) WHERE NOT list_contains({_SQL_STOP}, token)
""")
def c04_setdiff_positions(spark, sf_dir):
    stop = spark.createDataFrame([(w,) for w in STOP_WORDS], "token string")
    return TF.setdiff_positions(_bench_tokens(spark, sf_dir), stop, "token").select("item_id", "pos", "token")


@query("c05_unique_with_index", f"""
WITH t AS ({_SQL_BENCH_TOK}),
f AS (SELECT item_id, token, min(pos) AS fp FROM t GROUP BY 1, 2),
i AS (SELECT item_id, token, CAST(row_number() OVER (PARTITION BY item_id ORDER BY fp) - 1 AS INTEGER) AS idx FROM f)
SELECT t.item_id, t.pos, t.token, i.idx FROM t JOIN i USING (item_id, token)
""")
def c05_unique_with_index(spark, sf_dir):
    return TF.unique_with_index(_bench_tokens(spark, sf_dir), ["item_id"], "pos", "token") \
             .select("item_id", "pos", "token", "idx")


@query("e07_signed_hashed_vectors", f"""
WITH c AS (SELECT doc_id, CAST({md5_mod_sql('t', 4096)} AS BIGINT) AS bucket,
                  sum(CASE WHEN {md5_mod_sql("'sign-' || t", 2)} = 0 THEN -1.0 ELSE 1.0 END) AS value
           FROM (SELECT doc_id, unnest({_SQL_TOK}) AS t FROM documents) GROUP BY 1, 2)
SELECT doc_id, bucket, round(value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)), 6) AS value FROM c
""")
def e07_signed_hashed_vectors(spark, sf_dir):
    v = TF.hashed_vectors(_docs(spark, sf_dir), "doc_id", T.word_tokens("text"), 4096, signed=True, l2=True)
    return v.select("doc_id", "bucket", F.round("value", R).alias("value"))


@query("r04_a30_max_features_vocabulary", f"""
WITH t AS (SELECT doc_id, {_SQL_TOK} AS tok FROM documents),
g AS (SELECT doc_id, array_to_string(list_slice(tok, i, i + n - 1), ' ') AS term
      FROM (SELECT doc_id, tok, n, unnest(generate_series(1, len(tok) - n + 1)) AS i
            FROM t, (VALUES (1), (2)) v(n))),
s AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM g GROUP BY term),
k AS (SELECT * FROM s ORDER BY tf DESC, term LIMIT 500)
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id, df FROM k
""")
def r04_a30_max_features_vocabulary(spark, sf_dir):
    """The fitted vocabulary (A30) of a 1-2-gram bag limited to the 500 most
    frequent terms (R04), ids alphabetical over the kept terms."""
    model, _ = TF.NGramBag("doc_id", (1, 2), max_features=500).fit_counts(_docs(spark, sf_dir), T.word_tokens("text"))
    return model.vocabulary.select("term", "term_id", "df")
