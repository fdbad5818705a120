"""Queries for order-dependent operators (folds, batches, windows, Gini)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.functions import text as T
from featlab.functions.arrays import posexplode_values
from featlab.operators import sequential as S
from featlab.operators import token_windows as TW
from featlab.operators.folds import batches, kfold, stratified_kfold
from featlab.plans.registry import query
from featlab.sources.tables import read_table, spread

R = 6


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")


@query("w08_kfold_contiguous", """
SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders
""")
def w08_kfold_contiguous(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey")
    return kfold(o, ["o_orderkey"], 5).select("o_orderkey", "fold")


@query("w09_kfold_stratified", """
SELECT o_orderkey, o_orderstatus,
       CAST(ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS INTEGER) AS fold
FROM orders
""")
def w09_kfold_stratified(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return stratified_kfold(o, "o_orderstatus", ["o_orderkey"], 5).select("o_orderkey", "o_orderstatus", "fold")


@query("w10_batches", """
SELECT conv_id, turn, CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) // 64 AS BIGINT) AS batch
FROM conversations
""")
def w10_batches(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn")
    return batches(c, ["conv_id", "turn"], 64).select("conv_id", "turn", "batch")


@query("w01_cumulative_sums", """
SELECT event_id,
  round(sum(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cumsum,
  round(coalesce(sum(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS cumsum_excl,
  round(sum(value) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS cumsum_rev,
  round(coalesce(sum(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0), 6) AS cumsum_rev_excl
FROM events
""")
def w01_cumulative_sums(spark, sf_dir):
    e = _events(spark, sf_dir)
    out = S.cumulative_sum(e, [], ["ts", "event_id"], "value")
    return out.select("event_id", *[F.round(c, R).alias(c) for c in
                                    ("cumsum", "cumsum_excl", "cumsum_rev", "cumsum_rev_excl")])


@query("w02_moving_average", """
SELECT event_id, user_id, round(m, 6) AS moving_avg FROM (
  SELECT event_id, user_id, avg(value) OVER w AS m, count(value) OVER w AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
WHERE n = 5
""")
def w02_moving_average(spark, sf_dir):
    out = S.moving_average(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", 5)
    return out.select("event_id", "user_id", F.round("moving_avg", R).alias("moving_avg"))


@query("w03_sliding_min_max", """
SELECT event_id, min(value) OVER w AS min_value, max(value) OVER w AS max_value
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
""")
def w03_sliding_min_max(spark, sf_dir):
    out = S.sliding_range(_events(spark, sf_dir), [], ["ts", "event_id"], "value", 20)
    return out.select("event_id", "min_value", "max_value")


@query("w04_ema", """
WITH RECURSIVE o AS (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, event_id FROM events),
e AS (
  SELECT user_id, rn, event_id, 0.1 * value AS ema FROM o WHERE rn = 1
  UNION ALL
  SELECT o.user_id, o.rn, o.event_id, 0.9 * e.ema + 0.1 * o.value FROM e JOIN o ON o.user_id = e.user_id AND o.rn = e.rn + 1)
SELECT event_id, user_id, round(ema / (1 - pow(0.9, rn)), 6) AS ema FROM e
""")
def w04_ema(spark, sf_dir):
    out = S.ema(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", beta=0.9, debias=True,
                chunk_rows=2000)
    return out.select("event_id", "user_id", F.round("ema", R).alias("ema"))


@query("w05_context_window", f"""
WITH t AS (SELECT item_id, tok, unnest(generate_series(1, len(tok))) AS pos
           FROM (SELECT item_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS tok FROM benchmark))
SELECT item_id, CAST(pos AS INTEGER) AS pos, tok[pos] AS token,
       CASE WHEN pos > 1 THEN tok[pos - 1] END AS ctx_m1, CASE WHEN pos > 2 THEN tok[pos - 2] END AS ctx_m2,
       CASE WHEN pos < len(tok) THEN tok[pos + 1] END AS ctx_p1,
       CASE WHEN pos < len(tok) - 1 THEN tok[pos + 2] END AS ctx_p2
FROM t
""")
def w05_context_window(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    toks = (b.select("item_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()).withColumn("pos", F.col("pos") + 1))
    out = S.context_window(toks, ["item_id"], ["pos"], "token", 2)
    return out.select("item_id", "pos", "token", "ctx_m1", "ctx_m2", "ctx_p1", "ctx_p2")


@query("w06_skipgram_pairs", f"""
WITH t AS (SELECT item_id, tok, unnest(generate_series(1, len(tok))) AS pos
           FROM (SELECT item_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS tok FROM benchmark)),
o AS (SELECT unnest([-2, -1, 1, 2]) AS d)
SELECT item_id, CAST(pos AS INTEGER) AS c_pos, CAST(d AS INTEGER) AS "offset", tok[pos] AS centre, tok[pos + d] AS context
FROM t, o WHERE pos + d BETWEEN 1 AND len(tok)
""")
def w06_skipgram_pairs(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    toks = (b.select("item_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()).withColumn("pos", F.col("pos") + 1))
    return S.skipgram_pairs(toks, "item_id", "pos", "token", 2).withColumn("offset", F.col("offset").cast("int"))


def _document_tokens(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", T.word_tokens("text").alias("tok"))


_DOCUMENT_TOKENS = f"""
WITH t AS (SELECT doc_id, unnest(range(1, len(tok) + 1)) AS pos, unnest(tok) AS token
           FROM (SELECT doc_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS tok FROM documents))
"""


@query("w05_document_windows", _DOCUMENT_TOKENS + """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token, lag(token) OVER w AS ctx_m1, lag(token, 2) OVER w AS ctx_m2,
       lead(token) OVER w AS ctx_p1, lead(token, 2) OVER w AS ctx_p2
FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
""")
def w05_document_windows(spark, sf_dir):
    """The windows of ``w05_context_window`` for every token of every document."""
    out = TW.windows(_document_tokens(spark, sf_dir), ["doc_id"], "tok", 2)
    return out.select("doc_id", "pos", "token", "ctx_m1", "ctx_m2", "ctx_p1", "ctx_p2")


@query("w06_document_pairs", _DOCUMENT_TOKENS + """,
n AS (SELECT doc_id, CAST(pos AS INTEGER) AS c_pos, token AS centre, lag(token) OVER w AS m1, lag(token, 2) OVER w AS m2, lead(token) OVER w AS p1, lead(token, 2) OVER w AS p2
      FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, c_pos, -2 AS "offset", centre, m2 AS context FROM n WHERE m2 IS NOT NULL
UNION ALL SELECT doc_id, c_pos, -1, centre, m1 FROM n WHERE m1 IS NOT NULL
UNION ALL SELECT doc_id, c_pos, 1, centre, p1 FROM n WHERE p1 IS NOT NULL
UNION ALL SELECT doc_id, c_pos, 2, centre, p2 FROM n WHERE p2 IS NOT NULL
""")
def w06_document_pairs(spark, sf_dir):
    """The pairs of ``w06_skipgram_pairs`` for every token of every document."""
    return TW.skipgrams(_document_tokens(spark, sf_dir), ["doc_id"], "tok", 2)


@query("w07_normalized_gini", """
WITH p AS (SELECT l_extendedprice AS a,
                  row_number() OVER (ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_extendedprice) AS r,
                  count(*) OVER () AS n FROM lineitem),
q AS (SELECT l_extendedprice AS a, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r,
             count(*) OVER () AS n FROM lineitem),
gp AS (SELECT (sum(a * (n - r + 1)) / sum(a) - (any_value(n) + 1) / 2.0) / any_value(n) AS g FROM p),
gq AS (SELECT (sum(a * (n - r + 1)) / sum(a) - (any_value(n) + 1) / 2.0) / any_value(n) AS g FROM q)
SELECT round(gp.g, 6) AS gini, round(gq.g, 6) AS gini_max, round(gp.g / gq.g, 6) AS gini_norm FROM gp, gq
""")
def w07_normalized_gini(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    # (l_orderkey, l_linenumber) repeats in this data; with the price added,
    # rows still tied carry the same actual value, so their order cannot
    # change the result
    li = li.withColumn("_id", F.struct("l_orderkey", "l_linenumber", "l_extendedprice"))
    g = S.gini_normalized(li, "l_extendedprice", "l_quantity", "_id")
    return g.select(*[F.round(c, R).alias(c) for c in ("gini", "gini_max", "gini_norm")])


@query("w11_early_stop", """
WITH log AS (SELECT event_type, CAST(date_diff('hour', TIMESTAMP '2024-01-01', ts) // 24 AS BIGINT) AS round,
                    avg(value) AS metric FROM events GROUP BY 1, 2),
w AS (SELECT *, CASE WHEN metric > lag(metric) OVER (PARTITION BY event_type ORDER BY round) THEN 1 ELSE 0 END AS worse FROM log),
g AS (SELECT *, sum(1 - worse) OVER (PARTITION BY event_type ORDER BY round ROWS UNBOUNDED PRECEDING) AS grp FROM w),
s AS (SELECT *, sum(worse) OVER (PARTITION BY event_type, grp ORDER BY round ROWS UNBOUNDED PRECEDING) AS streak FROM g),
stop AS (SELECT event_type, min(round) AS stop_round FROM s WHERE streak >= 2 AND round > 5 GROUP BY 1),
best AS (SELECT event_type, arg_min(round, (metric, round)) AS best_round, count(*) AS rounds FROM log GROUP BY 1)
SELECT best.event_type, best_round, rounds, stop_round FROM best LEFT JOIN stop USING (event_type)
""")
def w11_early_stop(spark, sf_dir):
    e = _events(spark, sf_dir)
    log = (e.groupBy("event_type", F.floor(
        (F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 86400
    ).cast("bigint").alias("round")).agg(F.avg("value").alias("metric")))
    return S.early_stop(log, ["event_type"], "round", "metric", patience=2, min_rounds=5) \
            .select("event_type", "best_round", "rounds", "stop_round")
