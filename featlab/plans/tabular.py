"""Queries over the numeric / categorical tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.operators.mean_encoding import MeanEncoder
from featlab.plans.registry import md5_mod_sql, query
from featlab.sources.tables import read_table

R = 6  # rounding places shared with the oracle


@query("e11_oof_mean_encoding", """
WITH base AS (
  SELECT event_id, event_type, value, CAST(ntile(5) OVER (ORDER BY event_id) - 1 AS INTEGER) AS fold
  FROM events),
cf AS (SELECT event_type, fold, sum(value) AS s, count(value) AS c, count(*) AS n
       FROM base WHERE event_type IS NOT NULL GROUP BY 1, 2),
ct AS (SELECT event_type, sum(s) AS s, sum(c) AS c, sum(n) AS n FROM cf GROUP BY 1),
fp AS (SELECT fold, (t.s - sum(value)) / (t.c - count(value)) AS prior
       FROM base, (SELECT sum(value) AS s, count(value) AS c FROM base) t GROUP BY fold, t.s, t.c),
st AS (SELECT cf.event_type, cf.fold, ct.n - cf.n AS nout, ct.s - cf.s AS sout, ct.c - cf.c AS cout
       FROM cf JOIN ct USING (event_type))
SELECT b.event_id, b.event_type, b.value, b.fold,
       round(CASE WHEN st.cout > 0
                  THEN (1 / (1 + exp((st.nout - 2.0) / 1.0))) * fp.prior
                       + (1 - 1 / (1 + exp((st.nout - 2.0) / 1.0))) * (st.sout / st.cout)
                  ELSE fp.prior END, 6) AS event_type_pred
FROM base b JOIN fp USING (fold) LEFT JOIN st ON st.event_type = b.event_type AND st.fold = b.fold
""")
def e11_oof_mean_encoding(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "event_type", "value")
    enc, _ = MeanEncoder(["event_type"], "value", id_col="event_id", n_splits=5).fit_transform(events)
    return enc.select("event_id", "event_type", "value", "fold",
                      F.round("event_type_pred", R).alias("event_type_pred"))


# ---- numeric row functions (P03-P08, P16-P25) on lineitem ---------------------------------
from featlab.functions import scalar as P  # noqa: E402
from featlab.operators import encoders as EN  # noqa: E402
from featlab.operators import scaling as SC  # noqa: E402
from featlab.operators import stats as ST  # noqa: E402
from featlab.functions.hashing import md5_bin  # noqa: E402

_LI_KEYS = ("l_orderkey", "l_linenumber")


def _li(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "lineitem", *_LI_KEYS, *cols)


@query("p03_p08_binning_transforms", """
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN l_quantity < 5 THEN 0 WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 20 THEN 2
            WHEN l_quantity < 30 THEN 3 WHEN l_quantity < 40 THEN 4 ELSE 5 END AS INTEGER) AS fixed_box,
  CAST(floor(l_extendedprice / 1000.0) AS BIGINT) AS average_box,
  CAST(floor(log10(l_extendedprice)) AS BIGINT) AS log_box,
  round(ln(l_extendedprice) / ln(2.0), 6) AS log2,
  round((pow(l_extendedprice, 0.5) - 1) / 0.5, 6) AS box_cox_half,
  round(ln(l_extendedprice), 6) AS box_cox_zero,
  round(atan(l_discount * 10 - 0.5) * 2 / pi(), 6) AS atan_2pi
FROM lineitem
""")
def p03_p08_binning_transforms(spark, sf_dir):
    li = _li(spark, sf_dir, "l_quantity", "l_extendedprice", "l_discount")
    return li.select(*_LI_KEYS,
                     P.fixed_box("l_quantity", [5, 10, 20, 30, 40]).cast("int").alias("fixed_box"),
                     P.average_box("l_extendedprice", 1000.0).cast("bigint").alias("average_box"),
                     P.log_box("l_extendedprice").cast("bigint").alias("log_box"),
                     F.round(P.log_trans("l_extendedprice", 2), R).alias("log2"),
                     F.round(P.box_cox("l_extendedprice", 0.5), R).alias("box_cox_half"),
                     F.round(P.box_cox("l_extendedprice", 0.0), R).alias("box_cox_zero"),
                     F.round(P.atan_2pi(F.col("l_discount") * 10 - 0.5), R).alias("atan_2pi"))


@query("p16_p25_elementwise", """
SELECT l_orderkey, l_linenumber,
  round(l_quantity + l_tax, 6) AS add, round(l_quantity - l_tax, 6) AS sub, round(l_quantity * l_tax, 6) AS mul,
  round(l_tax / nullif(l_discount, 0), 6) AS div,
  CAST(floor((l_quantity - 25) / 7) AS BIGINT) AS floordiv,
  CAST(trunc((l_quantity - 25) / 7) AS BIGINT) AS truncdiv,
  round((l_quantity - 25) - 7 * floor((l_quantity - 25) / 7), 6) AS floormod,
  round((l_quantity - 25) % 7, 6) + 0.0 AS truncmod,
  round(pow(l_discount, 3), 6) AS pow3, round(l_tax * l_tax, 6) AS square, round(sqrt(l_quantity), 6) AS sqrt,
  round(exp(l_discount), 6) AS exp, round(ln(l_quantity), 6) AS ln, -l_quantity AS negative,
  CAST(sign(l_quantity - 25) AS DOUBLE) AS sign, round(1.0 / l_quantity, 6) AS reciprocal,
  abs(l_quantity - 25) AS abs, round_even(l_extendedprice / 100, 0) AS rint,
  CAST(ceil(l_extendedprice / 100) AS BIGINT) AS ceil, CAST(floor(l_extendedprice / 100) AS BIGINT) AS floor,
  greatest(l_tax, l_discount) AS maximum, least(l_tax, l_discount) AS minimum,
  round(cos(l_discount), 6) AS cos, round(sin(l_discount), 6) AS sin, round(tan(l_discount), 6) AS tan,
  round(acos(l_discount), 6) AS acos, round(asin(l_discount), 6) AS asin, round(atan(l_discount), 6) AS atan,
  round(l_quantity + l_tax + l_discount, 6) AS add_n, round(pow(l_tax - l_discount, 2), 6) AS sq_diff,
  CASE WHEN l_returnflag = 'R' THEN l_tax ELSE l_discount END AS where_
FROM lineitem
""")
def p16_p25_elementwise(spark, sf_dir):
    li = _li(spark, sf_dir, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    q, t, d, e = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), F.col("l_extendedprice")
    r = lambda c, n: F.round(c, R).alias(n)
    return li.select(*_LI_KEYS, r(P.add(q, t), "add"), r(P.subtract(q, t), "sub"), r(P.multiply(q, t), "mul"),
                     r(P.divide(t, d), "div"),
                     P.floordiv(q - 25, F.lit(7)).cast("bigint").alias("floordiv"),
                     P.truncatediv(q - 25, F.lit(7)).cast("bigint").alias("truncdiv"),
                     r(P.floormod(q - 25, F.lit(7)), "floormod"), r(P.truncatemod(q - 25, F.lit(7)), "truncmod"),
                     r(F.pow(d, 3), "pow3"), r(P.square(t), "square"), r(F.sqrt(q), "sqrt"), r(F.exp(d), "exp"),
                     r(F.log(q), "ln"), (-q).alias("negative"), F.signum(q - 25).alias("sign"),
                     r(P.reciprocal(q), "reciprocal"), F.abs(q - 25).alias("abs"), P.rint(e / 100).alias("rint"),
                     F.ceil(e / 100).cast("bigint").alias("ceil"), F.floor(e / 100).cast("bigint").alias("floor"),
                     P.maximum(t, d).alias("maximum"), P.minimum(t, d).alias("minimum"),
                     r(F.cos(d), "cos"), r(F.sin(d), "sin"), r(F.tan(d), "tan"),
                     r(P.safe_acos(d), "acos"), r(P.safe_asin(d), "asin"), r(F.atan(d), "atan"),
                     r(P.add_n(q, t, d), "add_n"), r(P.squared_difference(t, d), "sq_diff"),
                     P.where(F.col("l_returnflag") == "R", t, d).alias("where_"))


@query("p01_p02_parse_checks", r"""
SELECT part, count(*) AS count, TRY_CAST(part AS DOUBLE) IS NOT NULL AS is_float,
       regexp_matches(part, '^\s*[+-]?\d+\s*$') AS is_int
FROM (SELECT unnest(regexp_split_to_array(url, '[/?=&#:.]+')) AS part FROM pages) WHERE part <> '' GROUP BY part
""")
def p01_p02_parse_checks(spark, sf_dir):
    pg = read_table(spark, sf_dir, "pages", "url")
    parts = pg.select(F.explode(F.split("url", r"[/?=&#:.]+")).alias("part")).filter(F.col("part") != "")
    return (parts.groupBy("part").agg(F.count(F.lit(1)).alias("count"))
            .select("part", "count", P.is_float("part").alias("is_float"), P.is_int("part").alias("is_int")))


@query("p09_c03_one_hot", """
SELECT l_orderkey, l_linenumber, array_to_string(list_transform(range(0, 7), lambda i: CASE WHEN i = l_linenumber - 1 THEN 1 ELSE 0 END), ',') AS one_hot
FROM lineitem
""")
def p09_c03_one_hot(spark, sf_dir):
    li = _li(spark, sf_dir)
    return li.select(*_LI_KEYS, F.array_join(P.one_hot(F.col("l_linenumber") - 1, 7), ",").alias("one_hot"))


# ---- reductions, segments, quantiles (A01-A05, A11, A12) ------------------------------------
@query("a01_a03_reductions", """
SELECT l_returnflag, round(sum(l_quantity), 6) AS sum, round(avg(l_quantity), 6) AS mean, max(l_quantity) AS max,
       min(l_quantity) AS min, round(product(1 + l_tax / 100), 6) AS prod, bool_and(l_discount <> 0) AS "all",
       bool_or(l_discount <> 0) AS "any", CAST(count_if(l_discount <> 0) AS BIGINT) AS count_nonzero
FROM lineitem GROUP BY l_returnflag
""")
def a01_a03_reductions(spark, sf_dir):
    li = _li(spark, sf_dir, "l_returnflag", "l_quantity", "l_tax", "l_discount")
    x = F.col("l_quantity")
    return li.groupBy("l_returnflag").agg(
        F.round(F.sum(x), R).alias("sum"), F.round(F.avg(x), R).alias("mean"), F.max(x).alias("max"),
        F.min(x).alias("min"), F.round(F.product(1 + F.col("l_tax") / 100), R).alias("prod"),
        F.bool_and(F.col("l_discount") != 0).alias("all"), F.bool_or(F.col("l_discount") != 0).alias("any"),
        F.count_if(F.col("l_discount") != 0).alias("count_nonzero"))


@query("a02_logsumexp", """
SELECT l_returnflag, round(max(x) + ln(sum(exp(x - m))), 6) AS logsumexp
FROM (SELECT l_returnflag, l_quantity / 10 AS x, max(l_quantity / 10) OVER (PARTITION BY l_returnflag) AS m FROM lineitem)
GROUP BY l_returnflag
""")
def a02_logsumexp(spark, sf_dir):
    li = _li(spark, sf_dir, "l_returnflag", "l_quantity").withColumn("x", F.col("l_quantity") / 10)
    return ST.logsumexp(li, "x", ["l_returnflag"]).select("l_returnflag", F.round("logsumexp", R).alias("logsumexp"))


@query("a04_segment_ops", """
SELECT l_linenumber, round(sum(l_tax), 6) AS sum, round(avg(l_tax), 6) AS mean, max(l_tax) AS max,
       min(l_tax) AS min, round(product(1 + l_tax / 100), 6) AS prod
FROM lineitem GROUP BY l_linenumber
""")
def a04_segment_ops(spark, sf_dir):
    li = _li(spark, sf_dir, "l_tax")
    s = li.groupBy("l_linenumber").agg(F.round(F.sum("l_tax"), R).alias("sum"), F.round(F.avg("l_tax"), R).alias("mean"),
                                       F.max("l_tax").alias("max"), F.min("l_tax").alias("min"),
                                       F.round(F.product(1 + F.col("l_tax") / 100), R).alias("prod"))
    return s


@query("a05_sparse_segment", """
SELECT user_id, round(sum(value), 6) AS sum, round(avg(value), 6) AS mean, round(sum(value) / sqrt(count(value)), 6) AS sqrt_n
FROM events WHERE event_type = 'click' GROUP BY user_id
""")
def a05_sparse_segment(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "user_id", "event_type", "value").filter(F.col("event_type") == "click")
    s = ST.sparse_segment(e, "user_id", "value")
    return s.select("user_id", *[F.round(c, R).alias(c) for c in ("sum", "mean", "sqrt_n")])


@query("a11_quantiles", """
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.1, 0.25, 0.5, 0.75, 0.9]) AS q FROM lineitem)
SELECT [0.1, 0.25, 0.5, 0.75, 0.9][i]::DOUBLE AS prob, round(q[i], 6) AS value FROM q, range(1, 6) r(i)
""")
def a11_quantiles(spark, sf_dir):
    q = ST.quantiles(_li(spark, sf_dir, "l_extendedprice"), "l_extendedprice", [0.1, 0.25, 0.5, 0.75, 0.9])
    return q.select(F.col("prob").cast("decimal(3,2)").cast("double").alias("prob"), F.round("value", R).alias("value"))


@query("a12_quantile_bins", """
WITH e AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CAST((l_extendedprice > q[1])::INT + (l_extendedprice > q[2])::INT + (l_extendedprice > q[3])::INT AS INTEGER) AS bin
FROM lineitem, e
""")
def a12_quantile_bins(spark, sf_dir):
    b = ST.quantile_bins(_li(spark, sf_dir, "l_extendedprice"), "l_extendedprice", 4)
    return b.select(*_LI_KEYS, F.col("bin").cast("int").alias("bin"))


# ---- scalers (A06-A09), Box-Cox likelihood grid (A10) ------------------------------------
@query("a06_a09_scalers", """
SELECT l_orderkey, l_linenumber,
  round((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS minmax,
  round((l_discount - 0.05) / max(abs(l_discount - 0.05)) OVER (), 6) AS maxabs,
  round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS standard,
  round(l_tax / sqrt(sum(l_tax * l_tax) OVER ()), 6) AS l2
FROM lineitem
""")
def a06_a09_scalers(spark, sf_dir):
    li = _li(spark, sf_dir, "l_extendedprice", "l_discount", "l_quantity", "l_tax") \
        .withColumn("l_discount_c", F.col("l_discount") - 0.05)
    out = SC.Scaler("minmax", ["l_extendedprice"]).fit(li).transform(li, "_mm")
    out = SC.Scaler("maxabs", ["l_discount_c"]).fit(li).transform(out, "_ma")
    out = SC.Scaler("standard", ["l_quantity"]).fit(li).transform(out, "_st")
    out = SC.Scaler("l2", ["l_tax"]).fit(li).transform(out, "_l2")
    return out.select(*_LI_KEYS, F.round("l_extendedprice_mm", R).alias("minmax"),
                      F.round("l_discount_c_ma", R).alias("maxabs"), F.round("l_quantity_st", R).alias("standard"),
                      F.round("l_tax_l2", R).alias("l2"))


@query("a10_boxcox_llf_grid", """
SELECT CAST(lam AS DOUBLE) AS lmbda, round((lam - 1) * sum(ln(l_extendedprice)) - count(*) / 2.0 *
       ln(var_pop(CASE WHEN lam = 0 THEN ln(l_extendedprice) ELSE (pow(l_extendedprice, lam) - 1) / lam END)), 4) AS llf
FROM lineitem, (VALUES (-1.0), (-0.5), (0.0), (0.5), (1.0), (1.5), (2.0)) v(lam) WHERE l_extendedprice > 0 GROUP BY lam
""")
def a10_boxcox_llf_grid(spark, sf_dir):
    g = SC.boxcox_llf_grid(_li(spark, sf_dir, "l_extendedprice"), "l_extendedprice",
                           [-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0])
    return g.select("lmbda", F.round("llf", 4).alias("llf"))


# ---- feature screening (A13-A15 / F01 / F02), category stats (A16), bin counting (A29) -------
@query("a13_f01_low_variance", """
SELECT feature, round(var, 6) AS var, var < 0.01 AS low_variance FROM (
  SELECT 'l_quantity' AS feature, var_samp(l_quantity) AS var FROM lineitem UNION ALL
  SELECT 'l_extendedprice', var_samp(l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_discount', var_samp(l_discount) FROM lineitem UNION ALL
  SELECT 'l_tax', var_samp(l_tax) FROM lineitem)
""")
def a13_f01_low_variance(spark, sf_dir):
    v = ST.variance_report(_li(spark, sf_dir, "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
                           ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 0.01)
    return v.select("feature", F.round("var", R).alias("var"), "low_variance")


@query("a14_f01_dominant_value", """
WITH l AS (SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem UNION ALL
           SELECT 'l_linestatus', l_linestatus FROM lineitem UNION ALL
           SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem),
c AS (SELECT feature, value, count(*) AS n FROM l GROUP BY 1, 2)
SELECT feature, arg_min(value, (-n, value)) AS mode, max(n) AS mode_count, round(max(n) / sum(n), 6) AS share,
       max(n) / sum(n) >= 0.95 AS dominant
FROM c GROUP BY feature
""")
def a14_f01_dominant_value(spark, sf_dir):
    m = ST.mode_report(_li(spark, sf_dir, "l_returnflag", "l_linestatus"),
                       ["l_returnflag", "l_linestatus", "l_linenumber"], 0.95)
    return m.select("feature", "mode", "mode_count", F.round("share", R).alias("share"), "dominant")


@query("a15_f02_pearson", """
SELECT feature, round(r, 6) AS r, abs(r) <= 0.1 AS remove FROM (
  SELECT 'l_extendedprice' AS feature, corr(l_extendedprice, l_quantity) AS r FROM lineitem UNION ALL
  SELECT 'l_discount', corr(l_discount, l_quantity) FROM lineitem UNION ALL
  SELECT 'l_tax', corr(l_tax, l_quantity) FROM lineitem)
""")
def a15_f02_pearson(spark, sf_dir):
    p = ST.pearson_report(_li(spark, sf_dir, "l_extendedprice", "l_discount", "l_tax", "l_quantity"),
                          ["l_extendedprice", "l_discount", "l_tax"], "l_quantity", 0.1)
    return p.select("feature", F.round("r", R).alias("r"), "remove")


@query("a16_category_target_stats", """
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean, count(*) AS count FROM orders GROUP BY 1
""")
def a16_category_target_stats(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice")
    s = ST.category_target_stats(o, "o_orderpriority", "o_totalprice")
    return s.select("o_orderpriority", F.round("mean", R).alias("mean"), "count")


@query("a29_bin_counting", """
WITH p AS (SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS clicks, count(*) AS n
           FROM orders GROUP BY 1),
t AS (SELECT sum(clicks) AS tc, sum(n) AS tn FROM p)
SELECT o_orderpriority, clicks, n, round(clicks / n, 6) AS ctr,
       round(ln((clicks / (n - clicks)) / ((tc - clicks) / ((tn - n) - (tc - clicks)))), 6) AS odds_ratio
FROM p, t
""")
def a29_bin_counting(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderpriority", "o_orderstatus") \
        .withColumn("click", (F.col("o_orderstatus") == "F").cast("double"))
    b = ST.bin_counting(o, "o_orderpriority", "click", log=True)
    return b.select("o_orderpriority", "clicks", "n", F.round("ctr", R).alias("ctr"),
                    F.round("odds_ratio", R).alias("odds_ratio"))


# ---- encoders (E01-E03, E06, E08-E10, E12, E13) ----------------------------------------------
@query("e01_label_encode", """
SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS code FROM part
""")
def e01_label_encode(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    m = EN.fit_label_encoder(p, "p_type")
    return m.transform(p, "code").select("p_partkey", "p_type", "code")


@query("e02_e03_one_hot_dummy_effect", """
WITH c AS (SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code,
                  count(DISTINCT c_mktsegment) OVER () AS k FROM customer)
SELECT c_custkey, c_mktsegment,
  array_to_string(list_transform(range(0, k), lambda i: CASE WHEN i = code THEN 1 ELSE 0 END), ',') AS one_hot,
  array_to_string(list_transform(range(1, k), lambda i: CASE WHEN i = code THEN 1 ELSE 0 END), ',') AS dummy,
  array_to_string(list_transform(range(1, k), lambda i: CASE WHEN code = 0 THEN -1 WHEN i = code THEN 1 ELSE 0 END), ',') AS effect
FROM c
""")
def e02_e03_one_hot_dummy_effect(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    m = EN.fit_label_encoder(c, "c_mktsegment")
    coded = m.transform(c, "code")
    code = F.col("code")
    return coded.select("c_custkey", "c_mktsegment",
                        F.array_join(EN.one_hot_vector(code, m.size), ",").alias("one_hot"),
                        F.array_join(EN.one_hot_vector(code, m.size, drop_first=True), ",").alias("dummy"),
                        F.array_join(EN.one_hot_vector(code, m.size, effect=True), ",").alias("effect"))




@query("e06_md5_bin", f"""
SELECT p_partkey, p_name, CAST({md5_mod_sql('p_name', 999999)} + 1 AS BIGINT) AS bin FROM part
""")
def e06_md5_bin(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    return p.select("p_partkey", "p_name", md5_bin("p_name", 1_000_000).alias("bin"))


@query("e08_libffm_lines", f"""
SELECT p_partkey, CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS VARCHAR) || ' ' ||
  '0:' || CAST({md5_mod_sql("'p_brand-' || p_brand", 999999)} + 1 AS VARCHAR) || ':1 ' ||
  '1:' || CAST({md5_mod_sql("'p_type-' || p_type", 999999)} + 1 AS VARCHAR) || ':1 ' ||
  array_to_string(list_transform(string_split(replace(p_name, ' ', '$'), '$'),
     lambda it: '2:' || CAST({md5_mod_sql("'p_name-' || it", 999999)} + 1 AS VARCHAR) || ':1'), ' ') || ' ' ||
  '3:1:' || CAST(p_retailprice AS VARCHAR) AS line
FROM part
""")
def e08_libffm_lines(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_name", "p_size", "p_retailprice")
    # multi-valued cell: the words of the name joined by '$'
    p = p.withColumn("label", (F.col("p_size") > 25).cast("int")).withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit("$")))
    return p.select("p_partkey", EN.libffm_line("label", ["p_brand", "p_type", "p_name", "p_retailprice"],
                                                numeric=["p_retailprice"]).alias("line"))


_ORD_FIELDS = ("o_orderstatus", "o_totalprice", "o_orderpriority")


@query("e09_fm_feature_dictionary", """
WITH v AS (SELECT 'o_orderstatus' AS field, o_orderstatus AS value FROM orders UNION
           SELECT 'o_orderpriority', o_orderpriority FROM orders),
r AS (SELECT field, value, dense_rank() OVER (PARTITION BY field ORDER BY value) - 1 AS r FROM v),
n AS (SELECT count(DISTINCT o_orderstatus) AS ns FROM orders)
SELECT field, value, CAST(CASE WHEN field = 'o_orderstatus' THEN r ELSE ns + 1 + r END AS BIGINT) AS idx FROM r, n
UNION ALL SELECT 'o_totalprice', NULL, CAST(ns AS BIGINT) FROM n
""")
def e09_fm_feature_dictionary(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", *_ORD_FIELDS)
    d = EN.fit_feature_dictionary(o, numeric=["o_totalprice"])
    return d.table.select("field", "value", F.col("idx").cast("bigint").alias("idx"))


@query("e10_fm_parse", """
WITH n AS (SELECT count(DISTINCT o_orderstatus) AS ns FROM orders),
s AS (SELECT o_orderstatus AS v, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS r FROM (SELECT DISTINCT o_orderstatus FROM orders)),
p AS (SELECT o_orderpriority AS v, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS r FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o.o_orderkey, f.field_no, f.feat_idx, f.feat_val FROM orders o, n
  JOIN s ON s.v = o.o_orderstatus JOIN p ON p.v = o.o_orderpriority,
  LATERAL (SELECT 0 AS field_no, CAST(s.r AS BIGINT) AS feat_idx, 1.0::DOUBLE AS feat_val
           UNION ALL SELECT 1, CAST(n.ns AS BIGINT), o.o_totalprice
           UNION ALL SELECT 2, CAST(n.ns + 1 + p.r AS BIGINT), 1.0::DOUBLE) f
""")
def e10_fm_parse(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", *_ORD_FIELDS)
    d = EN.fit_feature_dictionary(o.select(*_ORD_FIELDS), numeric=["o_totalprice"])
    parsed = d.parse(o, keep=["o_orderkey"])
    z = F.posexplode(F.arrays_zip("xi", "xv")).alias("field_no", "z")
    return parsed.select("o_orderkey", z).select("o_orderkey", F.col("field_no").cast("int").alias("field_no"),
                                                 F.col("z.xi").alias("feat_idx"), F.col("z.xv").alias("feat_val"))


@query("e12_oof_mean_encoding_classes", """
WITH base AS (SELECT o_orderkey, o_orderpriority AS c, o_orderstatus AS y,
                     CAST(ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders),
cls AS (SELECT DISTINCT y AS t FROM base),
cf AS (SELECT c, fold, t, sum(CASE WHEN y = t THEN 1.0 ELSE 0.0 END) AS s, count(*) AS n FROM base, cls GROUP BY 1, 2, 3),
ct AS (SELECT c, t, sum(s) AS s, sum(n) AS n FROM cf GROUP BY 1, 2),
fp AS (SELECT f.fold, cls.t, (tot.s - sum(CASE WHEN b.y = cls.t THEN 1.0 ELSE 0.0 END)) / (tot.n - count(*)) AS prior
       FROM (SELECT DISTINCT fold FROM base) f, cls, base b,
            (SELECT t, sum(CASE WHEN y = t THEN 1.0 ELSE 0.0 END) AS s, count(*) AS n FROM base, cls GROUP BY t) tot
       WHERE b.fold = f.fold AND tot.t = cls.t GROUP BY f.fold, cls.t, tot.s, tot.n),
enc AS (SELECT cf.c, cf.fold, cf.t, ct.n - cf.n AS nout, (ct.s - cf.s) / (ct.n - cf.n) AS mean FROM cf JOIN ct USING (c, t)),
res AS (SELECT b.o_orderkey, e.t, CASE WHEN e.nout > 0 THEN (1 / (1 + exp((e.nout - 2.0) / 1.0))) * fp.prior
                                       + (1 - 1 / (1 + exp((e.nout - 2.0) / 1.0))) * e.mean ELSE fp.prior END AS v
        FROM base b JOIN enc e ON e.c = b.c AND e.fold = b.fold JOIN fp ON fp.fold = b.fold AND fp.t = e.t)
SELECT o_orderkey, round(max(v) FILTER (WHERE t = 'F'), 6) AS o_orderpriority_pred_F,
       round(max(v) FILTER (WHERE t = 'O'), 6) AS o_orderpriority_pred_O,
       round(max(v) FILTER (WHERE t = 'P'), 6) AS o_orderpriority_pred_P
FROM res GROUP BY o_orderkey
""")
def e12_oof_mean_encoding_classes(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    enc, _ = MeanEncoder(["o_orderpriority"], "o_orderstatus", id_col="o_orderkey",
                         target_type="classification").fit_transform(o)
    cols = [c for c in enc.columns if c.startswith("o_orderpriority_pred_")]
    return enc.select("o_orderkey", *[F.round(c, R).alias(c) for c in cols])


@query("e13_mean_encoder_table", """
WITH base AS (SELECT event_id, event_type, value, ntile(5) OVER (ORDER BY event_id) - 1 AS fold FROM events),
tot AS (SELECT sum(value) AS s, count(value) AS c FROM base),
fp AS (SELECT fold, (tot.s - sum(value)) / (tot.c - count(value)) AS prior FROM base, tot GROUP BY fold, tot.s, tot.c),
cf AS (SELECT event_type, fold, sum(value) AS s, count(value) AS c, count(*) AS n FROM base WHERE event_type IS NOT NULL GROUP BY 1, 2),
ct AS (SELECT event_type, sum(s) AS s, sum(c) AS c, sum(n) AS n FROM cf GROUP BY 1),
g AS (SELECT ct.event_type, fp.fold, fp.prior, ct.n - coalesce(cf.n, 0) AS nout,
             ct.s - coalesce(cf.s, 0) AS sout, ct.c - coalesce(cf.c, 0) AS cout
      FROM ct CROSS JOIN fp LEFT JOIN cf ON cf.event_type = ct.event_type AND cf.fold = fp.fold)
SELECT event_type AS value, round(sum(CASE WHEN cout > 0 THEN (1 / (1 + exp((nout - 2.0) / 1.0))) * prior
       + (1 - 1 / (1 + exp((nout - 2.0) / 1.0))) * (sout / cout) ELSE prior END) / 5, 6) AS enc
FROM g GROUP BY event_type
""")
def e13_mean_encoder_table(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "event_type", "value")
    _, model = MeanEncoder(["event_type"], "value", id_col="event_id").fit_transform(events)
    _, table = model.tables["event_type_pred"]
    return table.select("value", F.round("enc", R).alias("enc"))


@query("a28_measurement_quality", """
WITH m AS (SELECT l.l_partkey, l.l_extendedprice / l.l_quantity AS x, p.p_retailprice AS t
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
q AS (SELECT l_partkey, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM m GROUP BY 1)
SELECT l_partkey, count(*) AS n, round(stddev_samp(x), 6) AS precision, round(avg(x - t), 6) AS bias,
       count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM m JOIN q USING (l_partkey) GROUP BY l_partkey
""")
def a28_measurement_quality(spark, sf_dir):
    """Repeat measurements: each line's unit price is a measurement of its
    part's list price (precision, bias, IQR outliers per part)."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_quantity")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    m = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("x"), F.col("p_retailprice").alias("t"))
    q = ST.measurement_quality(m, "l_partkey", "x", "t")
    return q.select("l_partkey", "n", F.round("precision", R).alias("precision"), F.round("bias", R).alias("bias"),
                    "outliers")


@query("j01_e13_encode_new_rows", """
WITH base AS (SELECT event_id, event_type, value, ntile(5) OVER (ORDER BY event_id) - 1 AS fold FROM events),
tot AS (SELECT sum(value) AS s, count(value) AS c FROM base),
fp AS (SELECT fold, (tot.s - sum(value)) / (tot.c - count(value)) AS prior FROM base, tot GROUP BY fold, tot.s, tot.c),
cf AS (SELECT event_type, fold, sum(value) AS s, count(value) AS c, count(*) AS n FROM base WHERE event_type IS NOT NULL GROUP BY 1, 2),
ct AS (SELECT event_type, sum(s) AS s, sum(c) AS c, sum(n) AS n FROM cf GROUP BY 1),
g AS (SELECT ct.event_type, fp.fold, fp.prior, ct.n - coalesce(cf.n, 0) AS nout,
             ct.s - coalesce(cf.s, 0) AS sout, ct.c - coalesce(cf.c, 0) AS cout
      FROM ct CROSS JOIN fp LEFT JOIN cf ON cf.event_type = ct.event_type AND cf.fold = fp.fold),
tab AS (SELECT event_type, sum(CASE WHEN cout > 0 THEN (1 / (1 + exp((nout - 2.0) / 1.0))) * prior
        + (1 - 1 / (1 + exp((nout - 2.0) / 1.0))) * (sout / cout) ELSE prior END) / 5 AS enc FROM g GROUP BY 1),
dflt AS (SELECT avg(prior) AS d FROM fp)
SELECT o.src, o.row_id, o.event_type, round(coalesce(tab.enc, dflt.d), 6) AS event_type_pred
FROM (SELECT 'events' AS src, event_id AS row_id, event_type FROM events
      UNION ALL SELECT 'orders', o_orderkey, o_orderpriority FROM orders) o
CROSS JOIN dflt LEFT JOIN tab ON tab.event_type = o.event_type
""")
def j01_e13_encode_new_rows(spark, sf_dir):
    """Encode new rows with the encoder fitted on events (left join to the
    averaged table, misses -> mean fold prior): event rows hit the table,
    order priorities never occur as event types and take the prior."""
    events = read_table(spark, sf_dir, "events", "event_id", "event_type", "value")
    _, model = MeanEncoder(["event_type"], "value", id_col="event_id").fit_transform(events)
    new = (events.select(F.lit("events").alias("src"), F.col("event_id").alias("row_id"), "event_type")
           .unionByName(read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
                        .select(F.lit("orders").alias("src"), F.col("o_orderkey").alias("row_id"),
                                F.col("o_orderpriority").alias("event_type"))))
    return model.transform(new).select("src", "row_id", "event_type",
                                       F.round("event_type_pred", R).alias("event_type_pred"))
