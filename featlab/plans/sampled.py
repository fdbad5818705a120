"""Queries of counter-based randomness (P26, R05, Q03, W06), regularisation paths (M05), facet fits (G10) and early stops."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from featlab.functions import draws as D
from featlab.functions import text as T
from featlab.operators import encoders as EN
from featlab.operators import epochs as EP
from featlab.operators import factor_machine as FM
from featlab.operators import fits as FT
from featlab.operators import linear_paths as LP
from featlab.operators import segmentation as SG
from featlab.operators import sequential as S
from featlab.operators import token_windows as TW
from featlab.operators import unknown_words as U
from featlab.operators.folds import hash_fold
from featlab.plans.models_q import _doc_features
from featlab.plans.registry import query
from featlab.session import ensure_checkpoint_dir
from featlab.sources.records import SequenceRecords
from featlab.sources.tables import read_table, spread

R = 6


def _u(draw: str) -> str:
    return f"((('0x' || substr(md5('7:' || id || ':' || ({draw})), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"


def _z(first: str, second: str) -> str:
    return f"(sqrt(-2 * ln({_u(first)})) * cos(2 * pi() * {_u(second)}))"


_D, _C = 2 - 1 / 3, 1 / (9 * (2 - 1 / 3)) ** 0.5


@query("p26_counter_based_columns", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id FROM lineitem),
t AS (SELECT *, list_transform(range(16), lambda r: {_z('r * 2', 'r * 2 + 1')}) AS zs,
      list_transform(range(16), lambda r: struct_pack(x := {_z('r * 3', 'r * 3 + 1')}, u := {_u('r * 3 + 2')})) AS gs FROM r),
g AS (SELECT *, list_filter(gs, lambda s: 1 + s.x * {_C!r}::DOUBLE > 0 AND ln(s.u) < s.x * s.x / 2 + {_D!r}::DOUBLE - pow(1 + s.x * {_C!r}::DOUBLE, 3) * {_D!r}::DOUBLE
      + ln(greatest(pow(1 + s.x * {_C!r}::DOUBLE, 3), 1e-300)) * {_D!r}::DOUBLE)[1].x AS x FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, round({_u('0')} * 2 - 1, 6) AS uniform, round({_z('0', '1')}, 6) AS normal,
       round(list_filter(zs, lambda z: abs(z) <= 2)[1], 6) AS truncated, round(pow(1 + x * {_C!r}::DOUBLE, 3) * {_D!r}::DOUBLE * 1.5, 6) AS gamma FROM g
""")
def p26_counter_based_columns(spark, sf_dir):
    """Uniform, normal, truncated normal and gamma values of every line, from its keys alone."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.round(D.uniform(7, key, 0, -1.0, 1.0), R).alias("uniform"), F.round(D.normal(7, key), R).alias("normal"),
                     F.round(D.truncated_normal(7, key), R).alias("truncated"), F.round(D.gamma(7, key, 2.0, 1.5), R).alias("gamma"))


@query("w06_sampled_pairs", f"""
WITH t AS (SELECT doc_id, tok, unnest(range(1, len(tok) + 1)) AS pos FROM (SELECT doc_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS tok FROM documents)),
p AS (SELECT doc_id, pos, tok, list_sort(list_transform(list_filter([-2, -1, 1, 2], lambda o: pos + o BETWEEN 1 AND len(tok)),
        lambda o: md5('42:' || doc_id || ':' || pos || ':' || o) || o)) AS h FROM t),
k AS (SELECT doc_id, pos, tok, unnest(list_transform(h[1:2], lambda s: substr(s, 33)::INTEGER)) AS o FROM p)
SELECT doc_id, CAST(pos AS INTEGER) AS c_pos, o AS "offset", tok[pos] AS centre, tok[pos + o] AS context FROM k
""")
def w06_sampled_pairs(spark, sf_dir):
    """Two neighbours of each token of each document, drawn without replacement from the two on either side."""
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", T.word_tokens("text").alias("tok"))
    return TW.skipgrams(docs, ["doc_id"], "tok", 2, num_skips=2)


_N1 = "(SELECT CAST(ceil(sqrt(n)) AS BIGINT) FROM size_)"
_KEY = "((epoch + 1) * 1000003 + 42) % 2147483647"


def _mix_sql(x: str, round_: int, k: int) -> str:
    y = f"((({x} + {_KEY} + {k * 104729} + {round_ * 7919 + 1}) % 2147483647) * 48271 % 2147483647)"
    return f"(({y} * {y} + {y}) % 2147483647)"


@query("q03_r05_epoch_batches", f"""
WITH RECURSIVE s AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS tok, row_number() OVER (ORDER BY conv_id, turn) - 1 AS rn FROM conversations),
size_ AS (SELECT count(*)::BIGINT AS n FROM conversations),
dim AS (SELECT n, ceil(sqrt(n))::BIGINT AS n1, ((n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT)::BIGINT AS n2 FROM size_),
w AS (SELECT rn::BIGINT AS rn, epoch::BIGINT AS epoch, rn::BIGINT AS x, 0 AS step FROM s, (SELECT unnest([0, 1, 2]) AS epoch)
  UNION ALL
  SELECT rn, epoch, l3 * n2 + r3, step + 1 FROM (
    SELECT *, x // n2 AS l0, x % n2 AS r0,
      (l0 + {_mix_sql('r0', 0, 1)}) % n1 AS l1, (r0 + {_mix_sql('l1', 1, 1)}) % n2 AS r1,
      (l1 + {_mix_sql('r1', 0, 2)}) % n1 AS l2, (r1 + {_mix_sql('l2', 1, 2)}) % n2 AS r2,
      (l2 + {_mix_sql('r2', 0, 3)}) % n1 AS l3, (r2 + {_mix_sql('l3', 1, 3)}) % n2 AS r3
    FROM w, dim WHERE step = 0 OR x >= n)),
placed AS (SELECT w.rn, epoch, x FROM w, dim WHERE step > 0 AND x < n),
b AS (SELECT conv_id, turn, epoch, x // 16 AS batch, x % 16 AS place, tok, len(tok) AS n, max(len(tok)) OVER (PARTITION BY epoch, x // 16) AS longest FROM placed JOIN s USING (rn))
SELECT conv_id, turn, epoch::INTEGER AS epoch, batch, place, n::INTEGER AS tok_length,
       array_to_string(list_concat(tok, list_transform(range(0, longest - n), lambda i: '<PAD>')), ' ') AS padded FROM b
""")
def q03_r05_epoch_batches(spark, sf_dir):
    """Three shuffled epochs of padded batches of 16 turns."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", T.word_tokens("text").alias("tok"))
    b = EP.padded_batches(EP.epoch_batches(c, ["conv_id", "turn"], 16, epochs=3), ["tok"], "<PAD>")
    return b.select("conv_id", "turn", "epoch", "batch", "place", F.col("tok_length").cast("int").alias("tok_length"), F.array_join("tok", " ").alias("padded"))


_ALPHAS = (300.0, 30.0, 3.0, 0.3)


@query("m05_one_feature_paths", """
WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y, abs(l_orderkey) % 3 AS fold FROM lineitem),
f AS (SELECT DISTINCT fold FROM r),
t AS (SELECT f.fold, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS c, var_pop(x) AS v FROM f JOIN r ON r.fold <> f.fold GROUP BY 1),
g AS (SELECT * FROM (SELECT unnest([300.0, 30.0, 3.0, 0.3])::DOUBLE AS alpha), (SELECT unnest([1.0, 0.5, 0.0])::DOUBLE AS l1_ratio)),
w AS (SELECT fold, alpha, l1_ratio, sign(c) * greatest(abs(c) - alpha * l1_ratio, 0) / (v + alpha * (1 - l1_ratio)) AS w, mx, my FROM t, g),
e AS (SELECT alpha, l1_ratio, fold, avg(pow(y - (my + w * (x - mx)), 2)) AS mse FROM w JOIN r USING (fold) GROUP BY ALL)
SELECT alpha, l1_ratio, round(avg(mse) / 1e6, 6) AS error FROM e GROUP BY ALL
""")
def m05_one_feature_paths(spark, sf_dir):
    """Held-out error of lasso, elastic net and ridge over four penalties, one feature (soft threshold in closed form)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_extendedprice").withColumn("fold", (F.abs("l_orderkey") % 3).cast("int"))
    _, log = LP.cross_validate(li, ["l_quantity"], "l_extendedprice", "fold", _ALPHAS, (1.0, 0.5, 0.0))
    return spark.createDataFrame([(a, ratio, round(e / 1e6, R)) for a, ratio, _, e in log], "alpha double, l1_ratio double, error double")


@query("m05_document_paths")
def m05_document_paths(spark, sf_dir):
    """Lasso, elastic net and ridge paths of the labelled documents' quality over text features (standardised), the
    chosen model's score for every document."""
    feats = ["log_chars", "word_rate", "digit_rate", "lines"]
    docs = _doc_features(spark, sf_dir).withColumn("fold", hash_fold("doc_id", 5))
    stats = docs.agg(*[F.avg(c).alias(f"m_{c}") for c in feats], *[F.stddev_pop(c).alias(f"s_{c}") for c in feats]).first()
    x = docs.select("doc_id", "fold", "quality", *[((F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0)).alias(c) for c in feats])
    best, _ = LP.cross_validate(x, feats, "quality", "fold", l1_ratios=(1.0, 0.5, 0.0), intercepts=(True, False), n_alphas=30)
    score = F.lit(best["fit"].intercept)
    for c, w in zip(feats, best["fit"].weights):
        score = score + F.col(c) * float(w)
    return x.select("doc_id", F.lit(round(best["alpha"], R)).alias("alpha"), F.lit(best["l1_ratio"]).alias("l1_ratio"), F.lit(best["intercept"]).alias("with_intercept"),
                    F.round(score, R).alias("score"))


_QUADRATIC = """
WITH c AS (SELECT l_returnflag, l_quantity - 25 AS x, l_extendedprice / 1000 AS y FROM lineitem),
s AS (SELECT l_returnflag, count(*) AS n, sum(x) AS s1, sum(x*x) AS s2, sum(x*x*x) AS s3, sum(x*x*x*x) AS s4, sum(y) AS t0, sum(x*y) AS t1, sum(x*x*y) AS t2 FROM c GROUP BY 1),
d AS (SELECT *, n*(s2*s4 - s3*s3) - s1*(s1*s4 - s2*s3) + s2*(s1*s3 - s2*s2) AS det FROM s)
SELECT l_returnflag, n, round((t0*(s2*s4 - s3*s3) - s1*(t1*s4 - t2*s3) + s2*(t1*s3 - t2*s2)) / det, 5) AS c0,
  round((n*(t1*s4 - t2*s3) - t0*(s1*s4 - s2*s3) + s2*(s1*t2 - s2*t1)) / det, 5) AS c1,
  round((n*(s2*t2 - s3*t1) - s1*(s1*t2 - s2*t1) + t0*(s1*s3 - s2*s2)) / det, 6) + 0.0 AS c2 FROM d
"""


@query("g10_quadratic_fits", _QUADRATIC)
def g10_quadratic_fits(spark, sf_dir):
    """Order 2 per return flag (Cramer's rule in SQL)."""
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    rows = li.select("l_returnflag", (F.col("l_quantity") - 25).alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    f = FT.fitted_polynomials(rows, "y", "x", ["l_returnflag"], order=2)
    c = F.col("coefficients")
    return f.select("l_returnflag", "n", F.round(c[0], 5).alias("c0"), F.round(c[1], 5).alias("c1"), (F.round(c[2], 6) + 0.0).alias("c2"))


@query("g10_robust_fits")
def g10_robust_fits(spark, sf_dir):
    """Huber lines of the price over the quantity, per return flag and line status."""
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    f = FT.fitted_polynomials(li, "l_extendedprice", "l_quantity", ["l_returnflag", "l_linestatus"], robust=True)
    return f.withColumn("coefficients", F.transform("coefficients", lambda v: F.round(v, 4)))


@query("w11_no_gain_stop", """
WITH log AS (SELECT event_type, CAST(date_diff('hour', TIMESTAMP '2024-01-01', ts) // 24 AS BIGINT) AS round, avg(value) AS metric FROM events GROUP BY 1, 2),
b AS (SELECT *, arg_min(round, (metric, round)) OVER (PARTITION BY event_type ORDER BY round ROWS UNBOUNDED PRECEDING) AS best FROM log)
SELECT event_type, arg_min(round, (metric, round)) AS best_round, count(*) AS rounds, min(CASE WHEN round - best > 6 THEN round END) AS stop_round FROM b GROUP BY 1
""")
def w11_no_gain_stop(spark, sf_dir):
    """The first round more than six rounds after the best so far."""
    e = read_table(spark, sf_dir, "events", "event_type", "ts", "value")
    day = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 86400).cast("bigint")
    log = e.groupBy("event_type", day.alias("round")).agg(F.avg("value").alias("metric"))
    return S.early_stop(log, ["event_type"], "round", "metric", patience=None, no_gain=6).select("event_type", "best_round", "rounds", "stop_round")


@query("m08_fm_on_parsed_rows")
def m08_fm_on_parsed_rows(spark, sf_dir):
    """Factorization machine of the order price over parsed (index, value) rows: status, priority, customer and month."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate", "o_totalprice") \
        .withColumn("month", F.month("o_orderdate").cast("double") / 12)
    fields = ["o_orderstatus", "o_orderpriority", "o_custkey", "month"]
    d = EN.fit_feature_dictionary(o.select(*fields), numeric=["month"])
    parsed = d.parse(o, keep=["o_orderkey", "o_totalprice"])
    train = parsed.select((F.col("o_totalprice") / 100_000).alias("y"), "xi", "xv")
    model = FM.fit(train, d.table, len(fields), k=4, sweeps=2, l2=5.0)
    return FM.predict(parsed, model, len(fields), ["o_orderkey"]).select("o_orderkey", F.round("score", R).alias("score"))


@query("x11_unknown_words")
def x11_unknown_words(spark, sf_dir):
    """Benchmark passages without their spaces, cut by the documents' vocabulary, unknown runs by a tag model of the documents."""
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select(T.word_tokens("text").alias("tok"))
    vocabulary = docs.select(F.explode_outer("tok").alias("word")).filter(F.length("word") > 1).groupBy("word").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 4")
    texts = read_table(spark, sf_dir, "benchmark", "item_id", "text").select("item_id", F.array_join(T.word_tokens("text"), "").alias("text"))
    cut = SG.segment_text(texts, "text", vocabulary)
    return U.join_unknown(cut, "words", U.fit_tags(docs, "tok")).select("item_id", F.array_join("words", " ").alias("words"))


@query("s13_record_files", f"""
SELECT conv_id AS label, array_to_string(list_transform(regexp_extract_all(lower(text), '{T.WORD_CLASS}'), lambda w: len(w)), ',') AS lengths, turn::BIGINT AS turn FROM conversations
""")
def s13_record_files(spark, sf_dir):
    """Word lengths of every turn, written as record files and read back."""
    spark.dataSource.register(SequenceRecords)
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        F.col("conv_id").alias("label"), F.transform(T.word_tokens("text"), lambda w: F.length(w).cast("long")).alias("lengths"), F.array(F.col("turn").cast("long")).alias("turn"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}"
    rows.write.format("sequence_records").mode("append").save(folder)
    back = spark.read.format("sequence_records").schema(rows.schema).load(folder)
    return back.select("label", F.array_join("lengths", ",").alias("lengths"), F.col("turn")[0].alias("turn"))
