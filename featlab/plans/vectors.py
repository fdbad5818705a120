"""Queries over ``embeddings`` (vectors, matrices, similarity)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.functions import arrays as A
from featlab.operators import linalg as L
from featlab.operators.pruned_search import topk_pruned
from featlab.operators.vectors import fm_second_order, topk_similar
from featlab.plans.registry import ORACLE, query
from featlab.sources.tables import read_table

R = 6


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")


_SQL_VEC = "CAST(embedding AS DOUBLE[])"


@query("j07_topk_similarity", f"""
WITH n AS (SELECT vec_id, {_SQL_VEC} AS e, sqrt(list_sum(list_transform({_SQL_VEC}, lambda x: x * x))) AS nr FROM embeddings),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS other_id, list_dot_product(a.e, b.e) / (a.nr * b.nr) AS sim
      FROM n a JOIN n b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, other_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, other_id, round(sim, 6) AS sim FROM r WHERE rank <= 8
""")
def j07_topk_similarity(spark, sf_dir):
    t = topk_similar(_emb(spark, sf_dir), "vec_id", "embedding", k=8)
    return t.select("query_id", "rank", "other_id", F.round("sim", R).alias("sim"))


@query("j07_topk_pruned", ORACLE["j07_topk_similarity"])
def j07_topk_pruned(spark, sf_dir):
    """The same search by cells that can be skipped (blocks of 128 kB)."""
    t = topk_pruned(_emb(spark, sf_dir), "vec_id", "embedding", k=8, block_bytes=1 << 17)
    return t.select("query_id", "rank", "other_id", F.round("sim", R).alias("sim"))


@query("c10_c11_norms_and_centroid_cosine", f"""
WITH v AS (SELECT vec_id, label, {_SQL_VEC} AS e FROM embeddings),
d AS (SELECT label, i, avg(e[i]) AS m FROM v, range(1, 65) r(i) GROUP BY label, i),
c AS (SELECT label, list(m ORDER BY i) AS cen FROM d GROUP BY label),
x AS (SELECT v.vec_id, v.e, c.cen, sqrt(list_sum(list_transform(v.e, lambda t: t * t))) AS ne,
             sqrt(list_sum(list_transform(c.cen, lambda t: t * t))) AS nc FROM v JOIN c USING (label))
SELECT vec_id, round(ne, 6) AS norm, round(e[1] / ne, 6) AS unit_first,
       round(CASE WHEN ne * nc = 0 THEN 0 ELSE list_dot_product(e, cen) / (ne * nc) END, 6) AS cos_centroid
FROM x
""")
def c10_c11_norms_and_centroid_cosine(spark, sf_dir):
    e = _emb(spark, sf_dir).withColumn("e", A.to_double_array(F.col("embedding")))
    # class centroids: a per-(label, dim) average, then re-assembled (64 values per label)
    dims = (e.select("label", F.posexplode("e").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m")))
    cen = dims.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("s")) \
              .select("label", F.transform("s", lambda t: t["m"]).alias("cen"))
    x = e.join(cen, "label")
    return x.select("vec_id", F.round(A.l2_norm("e"), R).alias("norm"),
                    F.round(F.element_at(A.l2_normalize("e"), 1), R).alias("unit_first"),
                    F.round(A.cosine("e", "cen"), R).alias("cos_centroid"))


@query("l01_l04_gram_matrix", f"""
WITH c AS (SELECT vec_id AS i, j - 1 AS j, {_SQL_VEC}[j] AS v FROM embeddings, range(1, 65) r(j)),
g AS (SELECT a.j AS i, b.j AS j, sum(a.v * b.v) AS v FROM c a JOIN c b ON a.i = b.i GROUP BY 1, 2)
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(v, 6) AS v FROM g WHERE abs(i - j) <= 2
""")
def l01_l04_gram_matrix(spark, sf_dir):
    g = L.gram_matrix(_emb(spark, sf_dir), "embedding")
    return L.band_part(g, 2, 2).select(F.col("i").cast("bigint"), F.col("j").cast("bigint"), F.round("v", R).alias("v"))


@query("l03_trace_norm_diag", f"""
WITH c AS (SELECT vec_id AS i, j - 1 AS j, {_SQL_VEC}[j] AS v FROM embeddings, range(1, 65) r(j)),
g AS (SELECT a.j AS i, b.j AS j, sum(a.v * b.v) AS v FROM c a JOIN c b ON a.i = b.i GROUP BY 1, 2)
SELECT round(sum(CASE WHEN i = j THEN v ELSE 0 END), 6) AS trace, round(sqrt(sum(v * v)), 6) AS norm,
       round(max(CASE WHEN i = j THEN v END), 6) AS max_diag FROM g
""")
def l03_trace_norm_diag(spark, sf_dir):
    g = L.gram_matrix(_emb(spark, sf_dir), "embedding")
    t = L.trace_and_norm(g)
    d = L.diag_part(g).agg(F.max("v").alias("max_diag"))
    from featlab.operators.stats import attach_row
    return attach_row(t, d).select(F.round("trace", R).alias("trace"), F.round("norm", R).alias("norm"),
                                   F.round("max_diag", R).alias("max_diag"))


@query("l09_j06_fm_second_order", f"""
WITH n AS (SELECT count(DISTINCT o_orderstatus) AS ns FROM orders),
s AS (SELECT o_orderstatus AS v, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS r FROM (SELECT DISTINCT o_orderstatus FROM orders)),
p AS (SELECT o_orderpriority AS v, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS r FROM (SELECT DISTINCT o_orderpriority FROM orders)),
x AS (SELECT o.o_orderkey, f.idx, f.val FROM orders o, n JOIN s ON s.v = o.o_orderstatus JOIN p ON p.v = o.o_orderpriority,
        LATERAL (SELECT CAST(s.r AS BIGINT) AS idx, 1.0::DOUBLE AS val UNION ALL SELECT n.ns, o.o_totalprice / 1000
                 UNION ALL SELECT n.ns + 1 + p.r, 1.0::DOUBLE) f),
w AS (SELECT vec_id AS idx, k - 1 AS k, CAST(embedding[k] AS DOUBLE) AS wv FROM embeddings, range(1, 9) r(k)),
fk AS (SELECT o_orderkey, k, sum(wv * val) AS s, sum(wv * val * wv * val) AS s2 FROM x JOIN w USING (idx) GROUP BY 1, 2)
SELECT o_orderkey, round(0.5 * sum(s * s - s2), 6) AS fm2 FROM fk GROUP BY o_orderkey
""")
def l09_j06_fm_second_order(spark, sf_dir):
    from featlab.operators.encoders import fit_feature_dictionary
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    o = o.withColumn("o_totalprice", F.col("o_totalprice") / 1000)
    d = fit_feature_dictionary(o.drop("o_orderkey"), numeric=["o_totalprice"])
    parsed = d.parse(o, keep=["o_orderkey"])
    long = parsed.select("o_orderkey", F.explode(F.arrays_zip("xi", "xv")).alias("z")) \
                 .select("o_orderkey", F.col("z.xi").alias("idx"), F.col("z.xv").alias("value"))
    # factor weights: the first 8 components of the embedding with the same id, for the dictionary's indices
    w = _emb(spark, sf_dir).select(F.col("vec_id").alias("idx"),
                                   F.slice(A.to_double_array(F.col("embedding")), 1, 8).alias("vec")) \
        .join(d.table.select("idx"), "idx", "left_semi")
    f = fm_second_order(long, w, "o_orderkey", 8)
    return f.select("o_orderkey", F.round("fm2", R).alias("fm2"))


@query("c01_c09_array_ops", f"""
WITH v AS (SELECT vec_id, {_SQL_VEC} AS e FROM embeddings)
SELECT vec_id,
  CAST(list_position(e, list_max(e)) - 1 AS INTEGER) AS argmax,
  CAST(list_position(e, list_min(e)) - 1 AS INTEGER) AS argmin,
  round(e[3] + e[2] + e[1], 6) AS head3_sum,
  round(list_reverse(e)[1], 6) AS last,
  round(e[5] + e[10] + e[20], 6) AS gather_sum,
  array_to_string(list_transform(list_grade_up(list_grade_up(e)), lambda x: x - 1)[1:5], ',') AS rank_head,
  len(e) AS size
FROM v
""")
def c01_c09_array_ops(spark, sf_dir):
    e = _emb(spark, sf_dir).select("vec_id", A.to_double_array(F.col("embedding")).alias("e"))
    # The rank of each element is the inverse of the sorting permutation
    perm = F.transform(F.array_sort(F.transform("e", lambda x, i: F.struct(x.alias("v"), i.alias("i")))),
                       lambda s: s["i"])
    ranks = A.invert_permutation(perm)
    return e.select(
        "vec_id", A.argmax("e").alias("argmax"), A.argmin("e").alias("argmin"),
        F.round(F.aggregate(A.slice0("e", 0, 3), F.lit(0.0), lambda s, x: s + x), R).alias("head3_sum"),
        F.round(F.element_at(F.reverse("e"), 1), R).alias("last"),
        F.round(F.aggregate(A.gather("e", F.array(F.lit(4), F.lit(9), F.lit(19))), F.lit(0.0), lambda s, x: s + x), R)
        .alias("gather_sum"),
        F.array_join(F.slice(ranks, 1, 5), ",").alias("rank_head"), F.size("e").cast("bigint").alias("size"))


@query("c08_edit_distance", """
SELECT p_partkey, levenshtein(p_name, lower(p_type)) AS edit,
       round(levenshtein(p_name, lower(p_type)) / length(lower(p_type)), 6) AS edit_norm FROM part
""")
def c08_edit_distance(spark, sf_dir):
    # (ASCII columns: DuckDB's levenshtein counts bytes, ours characters)
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    lt = F.lower("p_type")
    return p.select("p_partkey", A.edit_distance("p_name", lt).cast("bigint").alias("edit"),
                    F.round(A.edit_distance("p_name", lt, normalize=True), R).alias("edit_norm"))


@query("c09_pad_sequences", r"""
WITH t AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS tok FROM benchmark),
m AS (SELECT max(len(tok)) AS ml FROM t)
SELECT item_id, len(list_concat(list_transform(range(0, ml - len(tok)), lambda x: ''), tok)) AS padded_len,
       ml - len(tok) AS pad, list_concat(list_transform(range(0, ml - len(tok)), lambda x: ''), tok)[ml] AS last
FROM t, m
""")
def c09_pad_sequences(spark, sf_dir):
    from featlab.functions import text as T
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text").select("item_id", T.word_tokens("text").alias("tok"))
    ml = b.agg(F.max(F.size("tok"))).first()[0]      # pad to the longest text: nothing is cut
    padded = A.pad_sequence(F.col("tok"), ml, "", padding="pre")
    return b.select("item_id", F.size(padded).cast("bigint").alias("padded_len"),
                    (F.lit(ml) - F.size("tok")).cast("bigint").alias("pad"), F.element_at(padded, -1).alias("last"))


@query("l05_l08_e15_factorizations", f"""
WITH c AS (SELECT vec_id AS k, j - 1 AS j, {_SQL_VEC}[j] AS v FROM embeddings, range(1, 65) r(j))
SELECT CAST(a.j AS BIGINT) AS i, CAST(b.j AS BIGINT) AS j, round(sum(a.v * b.v), 4) AS from_svd, round(sum(a.v * b.v), 4) AS from_qr,
  round(covar_samp(a.v, b.v), 4) + 0.0 AS from_components
FROM c a JOIN c b ON a.k = b.k GROUP BY 1, 2
""")
def l05_l08_e15_factorizations(spark, sf_dir):
    """All components of the SVD (L05), QR (L06) and principal components
    (L08/E15) of the embedding matrix, shown by what they rebuild: V S^2 V',
    R'R and the covariance."""
    e = _emb(spark, sf_dir)
    s, v = L.svd(e, "embedding")
    r = L.tall_skinny_qr(e, "embedding")
    var, pc = L.principal_components(e, "embedding")
    a, b, c = (v * s ** 2) @ v.T, r.T @ r, (pc * var) @ pc.T
    rows = [(i, j, float(a[i, j]), float(b[i, j]), float(c[i, j])) for i in range(len(a)) for j in range(len(a))]   # d x d numbers
    out = spark.createDataFrame(rows, "i long, j long, x double, y double, z double")
    return out.select("i", "j", F.round("x", 4).alias("from_svd"), F.round("y", 4).alias("from_qr"), (F.round("z", 4) + 0.0).alias("from_components"))


@query("l01_gram_of_embeddings", f"""
WITH c AS (SELECT vec_id AS k, j - 1 AS j, {_SQL_VEC}[j] AS v FROM embeddings, range(1, 65) r(j))
SELECT CAST(a.j AS BIGINT) AS i, CAST(b.j AS BIGINT) AS j, round(sum(a.v * b.v), 4) AS v FROM c a JOIN c b ON a.k = b.k GROUP BY 1, 2
""")
def l01_gram_of_embeddings(spark, sf_dir):
    """X'X by blocks."""
    x = L.from_arrays(_emb(spark, sf_dir), "vec_id", "embedding")
    return L.matmul(x, x, transpose_a=True).select("i", "j", F.round("v", 4).alias("v"))


@query("l01_class_products", f"""
WITH c AS (SELECT vec_id AS k, label, j, {_SQL_VEC}[j] AS v FROM embeddings, range(1, 65) r(j)),
m AS (SELECT label, j, avg(v) AS w FROM c WHERE label IS NOT NULL GROUP BY 1, 2)
SELECT c.k AS vec_id, CAST(m.label AS BIGINT) AS label, round(sum(c.v * m.w), 5) AS v FROM c JOIN m USING (j) GROUP BY 1, 2
""")
def l01_class_products(spark, sf_dir):
    """X W' by blocks: every vector times the mean vector of every class."""
    e = _emb(spark, sf_dir)
    x = L.from_arrays(e, "vec_id", "embedding")
    w = L.from_arrays(e.filter("label is not null").withColumn("label", F.col("label").cast("bigint")), "label", "embedding") \
        .groupBy("i", "j").agg(F.avg("v").alias("v"))
    return L.matmul(x, w, transpose_b=True).select(F.col("i").alias("vec_id"), F.col("j").alias("label"), F.round("v", 5).alias("v"))


@query("l06_orthonormal_columns", """
SELECT CAST(a.j - 1 AS BIGINT) AS i, CAST(b.j - 1 AS BIGINT) AS j, CASE WHEN a.j = b.j THEN 1.0 ELSE 0.0 END::DOUBLE AS v
FROM range(1, 65) a(j), range(1, 65) b(j)
""")
def l06_orthonormal_columns(spark, sf_dir):
    """Q'Q of the QR factorization of the embeddings: the unit matrix."""
    e = _emb(spark, sf_dir)
    q = L.orthonormal_rows(e, "embedding", L.tall_skinny_qr(e, "embedding"))
    return L.gram_matrix(q, "q").select("i", "j", (F.round("v", 6) + 0.0).alias("v"))
