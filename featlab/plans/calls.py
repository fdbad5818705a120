"""Queries that run library operators which no other query calls, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.functions import arrays as A
from featlab.functions import hashing as H
from featlab.functions import scalar as S
from featlab.functions import text as T
from featlab.functions.arrays import posexplode_values
from featlab.operators import encoders as EN
from featlab.operators import linalg as L
from featlab.operators import stats as ST
from featlab.operators import vocab as V
from featlab.plans.registry import md5_mod_sql, query
from featlab.sources.tables import read_table

R = 6


@query("p24_c02_cross_and_shape", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
SELECT vec_id, round(e[2] * e[6] - e[3] * e[5], 6) + 0.0 AS x, round(e[3] * e[4] - e[1] * e[6], 6) + 0.0 AS y, round(e[1] * e[5] - e[2] * e[4], 6) + 0.0 AS z,
  CAST(ceil(len(e) / 10.0) AS INTEGER) AS rows, CAST(len(e) % 10 AS INTEGER) AS in_last, 1 AS outer_size
FROM v
""")
def p24_c02_cross_and_shape(spark, sf_dir):
    e = A.to_double_array(F.col("embedding"))
    cross = S.cross3(F.slice(e, 1, 3), F.slice(e, 4, 3))
    shaped = A.reshape(e, 10)
    return read_table(spark, sf_dir, "embeddings", "vec_id", "embedding").select(
        "vec_id", *[(F.round(cross[k], R) + 0.0).alias(n) for k, n in enumerate("xyz")],
        F.size(shaped).alias("rows"), F.size(F.element_at(shaped, -1)).alias("in_last"), F.size(A.expand_dims(e)).alias("outer_size"))


@query("a01_a03_reduce_library", """
SELECT l_returnflag, round(sum(x), 6) AS sum, round(avg(x), 6) AS mean, max(x) AS max, min(x) AS min, round(product(x), 6) AS prod,
  bool_and(x <> 0) AS "all", bool_or(x <> 0) AS "any", count(*) FILTER (x <> 0) AS count_nonzero
FROM (SELECT l_returnflag, CAST(l_discount AS DOUBLE) AS x FROM lineitem) GROUP BY 1
""")
def a01_a03_reduce_library(spark, sf_dir):
    r = ST.reduce_all(read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_discount"), "l_discount", ["l_returnflag"])
    return r.withColumns({c: F.round(c, R) for c in ("sum", "mean", "prod")})


@query("j04_stop_word_anti_join", f"""
WITH stop AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS w FROM documents) WHERE length(w) <= 4),
t AS (SELECT item_id, CAST(unnest(range(0, len(l))) AS INTEGER) AS pos, unnest(l) AS term FROM (SELECT item_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS l FROM benchmark))
SELECT item_id, pos, term FROM t WHERE term NOT IN (SELECT w FROM stop)
""")
def j04_stop_word_anti_join(spark, sf_dir):
    words = read_table(spark, sf_dir, "documents", "text").select(F.explode(T.word_tokens("text")).alias("w")).filter(F.length("w") <= 4)
    rows = read_table(spark, sf_dir, "benchmark", "item_id", "text").select("item_id", posexplode_values(T.word_tokens("text")).alias("pos", "term")).filter("term is not null")
    return V.remove_words(rows, words).select("item_id", "pos", "term")


@query("e04_e05_hashing_library", f"""
SELECT o_orderkey, CAST({md5_mod_sql("'3:' || o_clerk", 1024)} AS INTEGER) AS bucket, CASE WHEN {md5_mod_sql("'7922:' || o_clerk", 2)} = 0 THEN 1 ELSE -1 END AS sign
FROM (SELECT o_orderkey, o_orderpriority || o_custkey AS o_clerk FROM orders)
""")
def e04_e05_hashing_library(spark, sf_dir):
    value = F.concat("o_orderpriority", F.col("o_custkey").cast("string"))
    return read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_custkey").select(
        "o_orderkey", H.hash_bucket(value, 1024, 3).alias("bucket"), H.hash_sign(value, 3).alias("sign"))


@query("u01_dictionary_of_both_parts", """
WITH s AS (SELECT 'o_orderstatus' AS field, o_orderstatus AS value FROM orders UNION SELECT 'o_orderpriority', o_orderpriority FROM orders),
n AS (SELECT count(*) AS n FROM s WHERE field = 'o_orderstatus')
SELECT field, value, CASE WHEN field = 'o_orderstatus' THEN 0 ELSE n END + row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS idx FROM s, n
""")
def u01_dictionary_of_both_parts(spark, sf_dir):
    """Dictionary of open and closed orders: the second part brings values the first lacks."""
    o = read_table(spark, sf_dir, "orders", "o_orderstatus", "o_orderpriority")
    return EN.fit_feature_dictionary(o.filter("o_orderstatus = 'O'"), others=o.filter("o_orderstatus <> 'O'")).table.select("field", "value", "idx")


@query("l02_transpose", """
SELECT CAST(j - 1 AS BIGINT) AS i, vec_id AS j, round(CAST(embedding[j] AS DOUBLE), 6) + 0.0 AS v FROM embeddings, range(1, 65) r(j)
""")
def l02_transpose(spark, sf_dir):
    t = L.transpose(L.from_arrays(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding"))
    return t.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), (F.round("v", R) + 0.0).alias("v"))


@query("l07_least_squares", """
SELECT round((c1 * g22 - c2 * g12) / (g11 * g22 - g12 * g12), 3) AS w1, round((c2 * g11 - c1 * g12) / (g11 * g22 - g12 * g12), 3) AS w2
FROM (SELECT sum(a * a) AS g11, sum(a * b) AS g12, sum(b * b) AS g22, sum(a * y) AS c1, sum(b * y) AS c2
  FROM (SELECT CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) AS b, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem))
""")
def l07_least_squares(spark, sf_dir):
    w = L.least_squares(read_table(spark, sf_dir, "lineitem", "l_quantity", "l_discount", "l_extendedprice"), ["l_quantity", "l_discount"], "l_extendedprice")
    return spark.createDataFrame([(round(float(w[0]), 3), round(float(w[1]), 3))], "w1 double, w2 double")
