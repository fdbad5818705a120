"""Queries for plot summaries (G01-G10) and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.operators import plotdata as G
from featlab.plans.registry import md5_mod_sql, query
from featlab.sources.tables import read_table

R = 6




@query("g01_histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, lo, hi, n FROM lineitem, r)
SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 10, 6) AS "left", count(*) AS count,
       round(count(*) / (any_value(n) * (any_value(hi) - any_value(lo)) / 10), 9) AS density FROM b GROUP BY bin
""")
def g01_histogram(spark, sf_dir):
    h = G.histogram(read_table(spark, sf_dir, "lineitem", "l_extendedprice"), "l_extendedprice", 10)
    return h.select("bin", F.round("left", R).alias("left"), "count", F.round("density", 9).alias("density"))


@query("g02_kernel_density", """
WITH r AS (SELECT min(l_discount) AS lo, max(l_discount) AS hi, count(*) AS n, stddev_pop(l_discount) AS sd FROM lineitem),
p AS (SELECT gi, lo + gi * (hi - lo) / 19 AS x, 1.06 * sd * pow(n, -0.2) AS h FROM r, range(0, 20) t(gi))
SELECT CAST(gi AS INTEGER) AS gi, round(any_value(x), 6) AS x,
       round(avg(exp(-pow(l_discount - x, 2) / (2 * h * h)) / (h * sqrt(2 * pi()))), 6) AS density
FROM lineitem, p GROUP BY gi
""")
def g02_kernel_density(spark, sf_dir):
    k = G.kde(read_table(spark, sf_dir, "lineitem", "l_discount"), "l_discount", 20)
    return k.select(F.col("gi").cast("int"), F.round("x", R).alias("x"), F.round("density", R).alias("density"))


@query("g03_box_summary", """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT o_orderpriority, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(o_totalprice) FILTER (WHERE o_totalprice >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(o_totalprice) FILTER (WHERE o_totalprice <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       count(*) FILTER (WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS outliers
FROM orders JOIN q USING (o_orderpriority) GROUP BY o_orderpriority, q1, median, q3
""")
def g03_box_summary(spark, sf_dir):
    b = G.box_summary(read_table(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice"), "o_totalprice",
                      ["o_orderpriority"])
    return b.select("o_orderpriority", *[F.round(c, R).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    "outliers")


@query("g04_correlation_matrix", """
SELECT a, b, round(r, 6) AS r FROM (
  SELECT 'l_quantity' AS a, 'l_quantity' AS b, corr(l_quantity, l_quantity) AS r FROM lineitem UNION ALL
  SELECT 'l_quantity', 'l_extendedprice', corr(l_quantity, l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem UNION ALL
  SELECT 'l_extendedprice', 'l_quantity', corr(l_extendedprice, l_quantity) FROM lineitem UNION ALL
  SELECT 'l_extendedprice', 'l_extendedprice', corr(l_extendedprice, l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem UNION ALL
  SELECT 'l_discount', 'l_quantity', corr(l_discount, l_quantity) FROM lineitem UNION ALL
  SELECT 'l_discount', 'l_extendedprice', corr(l_discount, l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_discount', 'l_discount', corr(l_discount, l_discount) FROM lineitem)
""")
def g04_correlation_matrix(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    m = G.correlation_matrix(read_table(spark, sf_dir, "lineitem", *cols), cols)
    return m.select("a", "b", F.round("r", R).alias("r"))


@query("g05_pie_shares", """
SELECT c_mktsegment, round(sum(c_acctbal), 6) AS total,
       round(100 * sum(c_acctbal) / sum(sum(c_acctbal)) OVER (), 6) AS share_pct FROM customer GROUP BY 1
""")
def g05_pie_shares(spark, sf_dir):
    p = G.pie_shares(read_table(spark, sf_dir, "customer", "c_mktsegment", "c_acctbal"), "c_mktsegment", "c_acctbal")
    return p.select("c_mktsegment", F.round("total", R).alias("total"), F.round("share_pct", R).alias("share_pct"))


@query("g06_stacked_bars", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 6) AS total,
       round(sum(sum(l_quantity)) OVER (PARTITION BY l_returnflag ORDER BY l_linestatus ROWS UNBOUNDED PRECEDING), 6) AS stack_top
FROM lineitem GROUP BY 1, 2
""")
def g06_stacked_bars(spark, sf_dir):
    s = G.stacked_bars(read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_quantity"),
                       "l_returnflag", "l_linestatus", "l_quantity")
    return s.select("l_returnflag", "l_linestatus", F.round("total", R).alias("total"),
                    F.round("stack_top", R).alias("stack_top"))


@query("g07_line_series", """
SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS bucket, event_type, round(avg(value), 6) AS mean, count(*) AS count
FROM events GROUP BY 1, 2
""")
def g07_line_series(spark, sf_dir):
    s = G.line_series(read_table(spark, sf_dir, "events", "ts", "event_type", "value"), "ts", "event_type", "value")
    return s.select(F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"), "event_type",
                    F.round("mean", R).alias("mean"), "count")


@query("g08_hash_sample", f"""
SELECT vec_id, label FROM embeddings WHERE {md5_mod_sql('CAST(vec_id AS VARCHAR)', 1000000)} < 200000
""")
def g08_hash_sample(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "label")
    return G.sample_by(e, "vec_id", 0.2).select("vec_id", "label")


@query("g09_joint_bins", """
WITH r AS (SELECT min(l_quantity) AS lx, max(l_quantity) AS hx, min(l_discount) AS ly, max(l_discount) AS hy FROM lineitem)
SELECT CAST(least(floor((l_quantity - lx) / ((hx - lx) / 5)), 4) AS INTEGER) AS bx,
       CAST(least(floor((l_discount - ly) / ((hy - ly) / 5)), 4) AS INTEGER) AS "by", count(*) AS count
FROM lineitem, r GROUP BY 1, 2
""")
def g09_joint_bins(spark, sf_dir):
    return G.joint_bins(read_table(spark, sf_dir, "lineitem", "l_quantity", "l_discount"), "l_quantity", "l_discount", 5)


@query("g10_fitted_lines", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept, count(*) AS n FROM lineitem GROUP BY 1
""")
def g10_fitted_lines(spark, sf_dir):
    f = G.fitted_lines(read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_extendedprice", "l_quantity"),
                       "l_extendedprice", "l_quantity", ["l_returnflag"])
    return f.select("l_returnflag", F.round("slope", R).alias("slope"), F.round("intercept", R).alias("intercept"), "n")


# ---- set operations (U01, U03-U06) -------------------------------------------------------------
from featlab.functions import text as T  # noqa: E402
from featlab.operators.folds import batches, split_flag  # noqa: E402
from featlab.operators import vocab as V  # noqa: E402


@query("u01_union_train_test", """
SELECT doc_id, quality FROM labels
UNION ALL SELECT doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def u01_union_train_test(spark, sf_dir):
    train = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    test = read_table(spark, sf_dir, "documents", "doc_id").join(train.select("doc_id"), "doc_id", "left_anti")
    return train.unionByName(test, allowMissingColumns=True).select("doc_id", "quality")


@query("u03_distinct_values", """
SELECT DISTINCT * FROM (SELECT 'p_brand' AS feature, p_brand AS value FROM part UNION ALL
  SELECT 'p_type', p_type FROM part UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part)
""")
def u03_distinct_values(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_brand", "p_type", "p_size")
    return V.distinct_values(p, ["p_brand", "p_type", "p_size"])


@query("u04_value_set_difference", """
SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE event_type = 'click'
EXCEPT SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events WHERE event_type = 'purchase'
""")
def u04_value_set_difference(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "user_id", "event_type", "ts") \
        .withColumn("day", F.date_format(F.to_date("ts"), "yyyy-MM-dd"))
    return V.value_difference(e.filter(F.col("event_type") == "click"),
                              e.filter(F.col("event_type") == "purchase"), ["user_id", "day"])


@query("u05_dictionary_edits", f"""
SELECT word FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS word FROM benchmark
                  UNION SELECT unnest(['featlab', 'spark']))
WHERE length(word) > 1
""")
def u05_dictionary_edits(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "text")
    words = V.word_rows(b, T.word_tokens("text")).distinct()
    added = spark.createDataFrame([("featlab",), ("spark",)], "word string")      # add_word / load_userdict
    deleted = words.filter(F.length("word") <= 1)                                 # del_word list
    return V.edit_dictionary(words, added, deleted).select("word")


@query("u06_hash_split", f"""
SELECT o_orderkey, {md5_mod_sql("'42-' || CAST(o_orderkey AS VARCHAR)", 1000000)} < 200000 AS is_valid FROM orders
""")
def u06_hash_split(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey")
    return o.select("o_orderkey", split_flag("o_orderkey", 0.2, 42).alias("is_valid"))


# ---- sequence datasets (Q01-Q03, J02, J03, X18) ---------------------------------------------
_SQL_CONV_TOK = f"regexp_extract_all(lower(text), '{T.WORD_CLASS}')"
_SQL_VOCAB = f"""vocab AS (SELECT term, row_number() OVER (ORDER BY count DESC, term) AS id FROM (
    SELECT term, count(*) AS count FROM (SELECT unnest({_SQL_CONV_TOK}) AS term FROM conversations) GROUP BY term)
  ORDER BY count DESC, term LIMIT 500)"""


def _conv_vocab(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", "text")
    return V.build_vocab(c, T.word_tokens("text"), 500).select("term", "id")


def _conv_rows(spark, sf_dir, keep_unknown: bool):
    """(conv_id, turn, pos, term, id): tokens looked up in the 500-term
    vocabulary, unknown -> 0 (J03) or dropped (J02)."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    rows = V.token_rows(c, ["conv_id", "turn"], T.word_tokens("text"))
    return V.lookup_ids(rows, _conv_vocab(spark, sf_dir), keep_unknown, vocab_size_bound=500)


@query("q01_vocabulary_and_labels", f"""
WITH {_SQL_VOCAB}
SELECT 'term' AS kind, term AS key, CAST(id AS BIGINT) AS id FROM vocab
UNION ALL SELECT 'label', role, dense_rank() OVER (ORDER BY role) - 1 FROM (SELECT DISTINCT role FROM conversations)
""")
def q01_vocabulary_and_labels(spark, sf_dir):
    from featlab.operators.encoders import fit_label_encoder
    vocab = _conv_vocab(spark, sf_dir).select(F.lit("term").alias("kind"), F.col("term").alias("key"), "id")
    roles = fit_label_encoder(read_table(spark, sf_dir, "conversations", "role"), "role").classes
    return vocab.unionByName(roles.select(F.lit("label").alias("kind"), F.col("value").alias("key"),
                                          F.col("code").alias("id")))


@query("q02_j03_id_sequences", f"""
WITH {_SQL_VOCAB},
t AS (SELECT conv_id, turn, role, tok, unnest(generate_series(1, len(tok))) AS pos
      FROM (SELECT conv_id, turn, role, {_SQL_CONV_TOK} AS tok FROM conversations)),
l AS (SELECT role, dense_rank() OVER (ORDER BY role) - 1 AS label FROM (SELECT DISTINCT role FROM conversations))
SELECT c.conv_id, c.turn, CAST(l.label AS BIGINT) AS label,
       coalesce(string_agg(CAST(coalesce(vocab.id, 0) AS VARCHAR), ' ' ORDER BY t.pos), '') AS ids
FROM conversations c JOIN l USING (role)
LEFT JOIN t ON t.conv_id = c.conv_id AND t.turn = c.turn
LEFT JOIN vocab ON vocab.term = t.tok[t.pos]
GROUP BY c.conv_id, c.turn, l.label
""")
def q02_j03_id_sequences(spark, sf_dir):
    from featlab.operators.encoders import fit_label_encoder
    seqs = V.to_sequences(_conv_rows(spark, sf_dir, keep_unknown=True), ["conv_id", "turn"])
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role").join(seqs, ["conv_id", "turn"], "left")
    roles = fit_label_encoder(read_table(spark, sf_dir, "conversations", "role"), "role")
    s = roles.transform(c, "label")
    ids = F.coalesce(F.array_join(F.transform("seq", lambda x: x.cast("string")), " "), F.lit(""))
    return s.select("conv_id", "turn", F.col("label").cast("bigint"), ids.alias("ids"))


@query("j02_x18_ids_to_text", f"""
WITH {_SQL_VOCAB},
t AS (SELECT conv_id, turn, tok, unnest(generate_series(1, len(tok))) AS pos
      FROM (SELECT conv_id, turn, {_SQL_CONV_TOK} AS tok FROM conversations))
SELECT conv_id, turn, string_agg(vocab.term, ' ' ORDER BY t.pos) AS text_from_ids, count(*) AS known
FROM t JOIN vocab ON vocab.term = t.tok[t.pos] GROUP BY conv_id, turn
""")
def j02_x18_ids_to_text(spark, sf_dir):
    # Unknown tokens dropped; then ids -> tokens by the reverse lookup
    ids = _conv_rows(spark, sf_dir, keep_unknown=False).select("conv_id", "turn", "pos", "id")
    back = V.ids_to_tokens(ids, _conv_vocab(spark, sf_dir), vocab_size_bound=500)
    w = V.to_sequences(back, ["conv_id", "turn"], "term", "w")
    return w.select("conv_id", "turn", F.array_join("w", " ").alias("text_from_ids"),
                    F.size("w").cast("bigint").alias("known"))


@query("q03_padded_batches", f"""
WITH s AS (SELECT conv_id, turn, len({_SQL_CONV_TOK}) AS n,
                  (row_number() OVER (ORDER BY conv_id, turn) - 1) // 16 AS batch FROM conversations)
SELECT conv_id, turn, CAST(batch AS BIGINT) AS batch, CAST(n AS INTEGER) AS length,
       CAST(max(n) OVER (PARTITION BY batch) AS INTEGER) AS padded_length,
       CAST(max(n) OVER (PARTITION BY batch) - n AS INTEGER) AS pad FROM s
""")
def q03_padded_batches(spark, sf_dir):
    from pyspark.sql import Window
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text") \
        .withColumn("tok", T.word_tokens("text"))
    b = batches(c, ["conv_id", "turn"], 16)
    w = Window.partitionBy("batch")            # at most 16 rows per batch
    b = b.withColumn("padded_length", F.max(F.size("tok")).over(w))
    out = b.withColumn("padded", F.concat("tok", F.array_repeat(F.lit("<PAD>"), F.col("padded_length") - F.size("tok"))))
    return out.select("conv_id", "turn", "batch", F.size("tok").cast("int").alias("length"),
                      F.col("padded_length").cast("int"), (F.size("padded") - F.size("tok")).cast("int").alias("pad"))


_PAIR_COLS = ("l_quantity", "l_extendedprice", "l_discount")


@query("g08_pair_plot_rows", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT l_orderkey, l_returnflag, '{a}' AS fx, '{b}' AS fy, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y "
    f"FROM lineitem"
    for a in _PAIR_COLS for b in _PAIR_COLS if a != b) + ")")
def g08_pair_plot_rows(spark, sf_dir):
    """Scatter-matrix data by label: all lines, every ordered pair of the
    numeric columns."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", *_PAIR_COLS)
    return G.pair_rows(li, list(_PAIR_COLS), ["l_orderkey", "l_returnflag"])
