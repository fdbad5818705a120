"""Queries for models, selection and dictionary text operators.

Fitted models are checked rows-only (plus property tests); the
out-of-fold stacking query uses a group-mean estimator so it has an exact
SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featlab.functions import text as T
from featlab.functions.arrays import explode_values, posexplode_values
from featlab.operators import models as MD
from featlab.operators import segmentation as SG
from featlab.operators.folds import kfold, stratified_kfold
from featlab.plans.registry import md5_mod_sql, query
from featlab.session import written_table
from featlab.sources.tables import read_table, spread

R = 6


def _doc_features(spark, sf_dir):
    """Text features of every document; ``quality`` and ``toxic`` are NULL
    for those without a label."""
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "n_chars", "text")
    d = docs.select("doc_id", F.log("n_chars").alias("log_chars"),
                    (F.size(T.word_tokens("text")) / F.greatest(F.col("n_chars"), F.lit(1))).alias("word_rate"),
                    ((F.length("text") - F.length(F.translate("text", "0123456789", ""))) / F.greatest(F.col("n_chars"), F.lit(1))).alias("digit_rate"),
                    (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("double").alias("lines"))
    # fits read the features many times: the texts are read once
    return written_table(d.join(lab, "doc_id", "left"))


@query("m09_oof_stacking_group_mean", """
WITH tr AS (SELECT o_orderkey, o_orderpriority AS c, o_totalprice AS y,
                   ntile(3) OVER (ORDER BY o_orderkey) - 1 AS fold FROM orders WHERE o_orderstatus <> 'P'),
te AS (SELECT o_orderkey, o_orderpriority AS c FROM orders WHERE o_orderstatus = 'P'),
f AS (SELECT DISTINCT fold FROM tr),
m AS (SELECT f.fold, t.c, avg(t.y) AS mu FROM f JOIN tr t ON t.fold <> f.fold GROUP BY 1, 2),
p AS (SELECT f.fold, avg(t.y) AS prior FROM f JOIN tr t ON t.fold <> f.fold GROUP BY 1),
oof AS (SELECT tr.o_orderkey, coalesce(m.mu, p.prior) AS score FROM tr JOIN p USING (fold)
        LEFT JOIN m ON m.fold = tr.fold AND m.c = tr.c),
tst AS (SELECT te.o_orderkey, avg(coalesce(m.mu, p.prior)) AS score FROM te CROSS JOIN p
        LEFT JOIN m ON m.fold = p.fold AND m.c = te.c GROUP BY 1)
SELECT o_orderkey, round(score, 6) AS score, 'oof' AS part FROM oof
UNION ALL SELECT o_orderkey, round(score, 6), 'test' FROM tst
""")
def m09_oof_stacking_group_mean(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    train = kfold(o.filter(F.col("o_orderstatus") != "P"), ["o_orderkey"], 3)
    test = o.filter(F.col("o_orderstatus") == "P")

    def fit(df):   # group-mean "model": per-category means + the overall mean
        return (df.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mu")),
                df.agg(F.avg("o_totalprice").alias("prior")))

    def score(m, df):
        means, prior = m
        from featlab.operators.stats import attach_row
        j = attach_row(df.join(means, "o_orderpriority", "left"), prior)
        return j.select("o_orderkey", F.coalesce("mu", "prior").alias("score"))

    oof, tst = MD.oof_predictions(train, test, "fold", "o_orderkey", fit, score)
    return (oof.select("o_orderkey", F.round("score", R).alias("score"), F.lit("oof").alias("part"))
            .unionByName(tst.select("o_orderkey", F.round("score", R).alias("score"), F.lit("test").alias("part"))))


@query("m04_m06_logistic_cv")
def m04_m06_logistic_cv(spark, sf_dir):
    """Logistic regression (C = 1) with a fold-column grid search over C
    on the labelled documents; predictions for every document."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    docs = MD.assemble(_doc_features(spark, sf_dir), ["log_chars", "word_rate", "lines"])
    x = kfold(docs.filter(F.col("quality").isNotNull()), ["doc_id"], 3).withColumn("label", F.col("quality").cast("double"))
    n = x.count()
    est = MD.logistic(1.0, n)
    cv = MD.grid_search(est, {"regParam": [1.0 / (c * n) for c in (0.1, 1.0, 10.0)]},
                        BinaryClassificationEvaluator(), fold_col="fold")
    model = cv.fit(x.withColumn("fold", F.col("fold").cast("int")))
    from pyspark.ml.functions import vector_to_array
    return model.transform(docs).select("doc_id", F.col("prediction").cast("int").alias("pred"),
                                        F.round(vector_to_array("probability")[1], R).alias("p1"))


@query("m01_m02_gbt_cv_rounds")
def m01_m02_gbt_cv_rounds(spark, sf_dir):
    """Boosted regression trees with per-round held-out loss per fold
    (the table early stopping reads), 3 folds x 20 rounds over all documents."""
    df = kfold(_doc_features(spark, sf_dir), ["doc_id"], 3)
    x = MD.assemble_for_trees(df, ["log_chars", "word_rate", "digit_rate"]).withColumn("label", F.col("lines"))
    return MD.cv_rounds(x, "fold", "regression", max_iter=20, maxDepth=3, seed=7)


@query("m08_fm_classifier")
def m08_fm_classifier(spark, sf_dir):
    """Factorization machine (factor size 8) on the document features, fit on
    the labelled documents; predictions for every document."""
    docs = MD.assemble(_doc_features(spark, sf_dir), ["log_chars", "word_rate", "lines"])
    x = docs.filter(F.col("toxic").isNotNull()).withColumn("label", F.col("toxic").cast("double"))
    m = MD.factorization_machine("binary", 8, maxIter=20, seed=3).fit(x)
    return m.transform(docs).select("doc_id", F.col("prediction").cast("int").alias("pred"))


@query("m07_m11_text_classifier")
def m07_m11_text_classifier(spark, sf_dir):
    """Hashed TF-IDF + logistic regression text classifier (re-aimed
    neural classifier): class and probability of every document. Labelled
    ones are scored by the fold model that did not see them, the others by
    the mean over the fold models."""
    from pyspark.ml.functions import vector_to_array
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    # the hashed counts do not depend on a fold: every text is read and hashed once, fits and scores read the sparse vectors
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", T.word_tokens("text").alias("tok"))
    docs = written_table(MD.hashed_terms("tok", 1 << 14).transform(docs).drop("tok"))
    train = written_table(stratified_kfold(lab.join(docs, "doc_id"), "quality", ["doc_id"], 3).withColumn("label", F.col("quality").cast("double")))
    rest = docs.join(lab.select("doc_id"), "doc_id", "left_anti")
    pipe = MD.term_classifier("label")
    score = lambda m, d: m.transform(d).select("doc_id", vector_to_array("probability")[1].alias("score"))
    oof, others = MD.oof_predictions(train, rest, "fold", "doc_id", pipe.fit, score)
    return oof.unionByName(others).select("doc_id", (F.col("score") > 0.5).cast("int").alias("pred"), F.round("score", R).alias("p1"))


@query("f04_f09_f10_linear_selection")
def f04_f09_f10_linear_selection(spark, sf_dir):
    """Least-squares weights (F04), stability selection share (F09) and
    recursive-elimination rank (F10) for the lineitem numeric columns."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                    "l_extendedprice").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    cols = ["l_quantity", "l_discount", "l_tax"]
    w = MD.linear_weights(li, cols, "l_extendedprice")
    st = MD.stability_selection(li, cols, "l_extendedprice", alpha=0.025, resamples=10)
    rk = dict(MD.recursive_elimination(li, cols, "l_extendedprice"))
    rows = [(c, float(w[c]), float(st[c]), int(rk[c])) for c in cols]
    return spark.createDataFrame(rows, "feature string, weight double, stability double, rfe_rank int")


@query("q04_q05_word_vectors")
def q04_q05_word_vectors(spark, sf_dir):
    """Skip-gram word vectors (size 16, min count 5) and mean-of-words
    document vectors (all components, rounded)."""
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", T.word_tokens("text").alias("tok"))
    m = MD.word_vectors(docs, "tok", size=16, window=5, min_count=5)
    from pyspark.ml.functions import vector_to_array
    return m.transform(docs).select("doc_id", F.transform(vector_to_array("doc_vec"), lambda v: F.round(v, R)).alias("vec"))


@query("x17_topic_keywords")
def x17_topic_keywords(spark, sf_dir):
    """LDA topic keywords: per document the 5 words closest to its topic mix."""
    from featlab.plans.text import keyword_tokens
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", keyword_tokens("text").alias("tok"))
    return MD.topic_keywords(docs, "doc_id", "tok", k=4, top=5, method="lda")


@query("x14_porter_stems")
def x14_porter_stems(spark, sf_dir):
    """Porter stems of the English documents' distinct tokens, joined back
    to every token position."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang").filter(F.col("lang") == "en")
    toks = (d.select("doc_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))
    return SG.stems(toks, "token").select("doc_id", "pos", "token", "stem")


def _wordpiece_vocab(spark, sf_dir):
    from featlab.operators.text_features import term_counts, top_terms
    docs = read_table(spark, sf_dir, "documents", "text")
    words = top_terms(term_counts(docs, T.word_tokens("text")), 3000).select(F.col("term").alias("token"))
    tails = (words.select(F.explode(F.array(F.substring("token", -2, 2), F.substring("token", -3, 3))).alias("t"))
             .select(F.concat(F.lit("##"), "t").alias("token")).distinct())
    return words.unionByName(tails).distinct()


@query("x08_wordpiece", f"""
WITH RECURSIVE w AS (SELECT t AS token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS t FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT 3000),
vocab AS (SELECT token FROM w UNION SELECT '##' || right(token, 2) FROM w UNION SELECT '##' || right(token, 3) FROM w),
toks AS (SELECT item_id, CAST(unnest(range(0, len(l))) AS INTEGER) AS pos, unnest(l) AS token FROM (SELECT item_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS l FROM benchmark)),
d AS (SELECT DISTINCT token FROM toks),
best AS (SELECT d.token, s.i, max(e.k) AS k FROM d, range(1, 60) s(i), range(1, 60) e(k)
  WHERE s.i + e.k - 1 <= length(d.token) AND (CASE WHEN s.i > 1 THEN '##' ELSE '' END) || substring(d.token, s.i, e.k) IN (SELECT token FROM vocab) GROUP BY 1, 2),
walk AS (SELECT token, CAST(1 AS BIGINT) AS i, CAST('' AS VARCHAR) AS pieces FROM d
  UNION ALL SELECT walk.token, walk.i + k, pieces || ' ' || CASE WHEN walk.i > 1 THEN '##' ELSE '' END || substring(walk.token, walk.i, k) FROM walk JOIN best ON best.token = walk.token AND best.i = walk.i)
SELECT item_id, pos, toks.token, coalesce(substring(pieces, 2), '[UNK]') AS pieces
FROM toks LEFT JOIN (SELECT * FROM walk WHERE i > length(token)) f ON f.token = toks.token
""")
def x08_wordpiece(spark, sf_dir):
    """WordPiece over benchmark tokens with a vocabulary learned from the
    documents: their 3000 most frequent words plus every 2- and 3-letter
    word ending as a ``##`` continuation."""
    vocab = _wordpiece_vocab(spark, sf_dir)
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    toks = (b.select("item_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))
    out = SG.wordpiece_tokens(toks, "token", vocab)
    return out.select("item_id", "pos", "token", F.array_join("pieces", " ").alias("pieces"))


@query("x08_document_wordpiece")
def x08_document_wordpiece(spark, sf_dir):
    """``x08_wordpiece`` for every token of every document (no SQL: it tries
    all pairs of places of each distinct token; compared with brute force)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    toks = (d.select("doc_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))
    out = SG.wordpiece_tokens(toks, "token", _wordpiece_vocab(spark, sf_dir))
    return out.select("doc_id", "pos", "token", F.array_join("pieces", " ").alias("pieces"))


@query("j08_dictionary_matches", f"""
WITH d AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS w FROM benchmark)
           WHERE length(w) >= 6),
m AS (SELECT max(length(w)) AS ml FROM d),
c AS (SELECT conv_id, turn, i, L, substring(lower(text), i, L) AS w
      FROM conversations, m, range(1, length(text) + 1) r(i), range(1, m.ml + 1) s(L) WHERE i + L - 1 <= length(text))
SELECT conv_id, turn, CAST(i AS INTEGER) AS start, w AS word FROM c JOIN d USING (w)
""")
def j08_dictionary_matches(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "text")
    dic = (b.select(explode_values(T.word_tokens("text")).alias("word"))
           .filter(F.col("word").isNotNull() & (F.length("word") >= 6)).distinct())
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text") \
        .withColumn("key", F.struct("conv_id", "turn")).withColumn("lt", F.lower("text"))
    m = SG.dictionary_matches(c, "key", "lt", dic)
    return m.select(F.col("key.conv_id").alias("conv_id"), F.col("key.turn").alias("turn"),
                    F.col("start").cast("int").alias("start"), "word")




@query("r05_seeded_shuffle", f"""
SELECT conv_id, turn, role, row_number() OVER (ORDER BY {md5_mod_sql("'42-' || CAST(conv_id * 1000 + turn AS VARCHAR)", 2147483647)},
       conv_id * 1000 + turn) AS shuffle_rank FROM conversations
""")
def r05_seeded_shuffle(spark, sf_dir):
    """Seeded shuffle order of the conversations (rows stay aligned; the
    order depends only on the seed and the ids, not on partitioning)."""
    from featlab.operators.folds import shuffle_order
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role") \
        .withColumn("key", F.col("conv_id") * 1000 + F.col("turn"))
    return shuffle_order(c, "key", seed=42).select("conv_id", "turn", "role", "shuffle_rank")


@query("p26_random_columns")
def p26_random_columns(spark, sf_dir):
    """Seeded normal, uniform, gamma and truncated-normal columns and
    constant arrays next to lineitem keys (reproducible for a fixed
    partitioning of the scan)."""
    from featlab.functions import scalar as P
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    out = li.select("l_orderkey", "l_linenumber", P.random_normal(7, 0.0, 1.0).alias("normal"),
                    P.random_uniform(7, -1.0, 1.0).alias("uniform"),
                    F.array_join(P.fill(3, 0.5), ",").alias("fill"), F.array_join(P.zeros(2), ",").alias("zeros"))
    return P.with_random_columns(out, 7, gamma={"gamma": (2.0, 1.5)}, truncated_normal={"trunc_normal": (0.0, 1.0)})


@query("x15_english_preprocess")
def x15_english_preprocess(spark, sf_dir):
    """English preprocessing: whitespace tokens that pass the checks (no
    digit, no leading symbol, not a stop word), then a lemma join against a
    (form, lemma) table - here the Porter stems of the corpus vocabulary."""
    from featlab.plans.text import STOP_WORDS
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang").filter(F.col("lang") == "en")
    toks = (d.select("doc_id", posexplode_values(T.whitespace_tokens(F.lower("text"))).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))
    kept = toks.filter(T.keep_token("token") & ~F.col("token").isin(*STOP_WORDS))
    forms = kept.select("token").distinct()
    lemmas = SG.stems(forms, "token", "lemma").select(F.col("token").alias("form"), "lemma")
    return SG.lemmatize(kept, "token", lemmas).select("doc_id", "pos", "token", "lemma")


@query("j09_tag_join", f"""
WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '{T.WORD_CLASS}')) AS word, lang FROM documents),
c AS (SELECT word, lang, count(*) AS n FROM w GROUP BY 1, 2),
tags AS (SELECT word, arg_min(lang, (-n, lang)) AS tag FROM c GROUP BY word),
t AS (SELECT item_id, tok, unnest(generate_series(1, len(tok))) AS pos
      FROM (SELECT item_id, regexp_extract_all(lower(text), '{T.WORD_CLASS}') AS tok FROM benchmark))
SELECT item_id, CAST(pos - 1 AS INTEGER) AS pos, tok[pos] AS token, coalesce(tags.tag, 'x') AS tag
FROM t LEFT JOIN tags ON tags.word = tok[pos]
""")
def j09_tag_join(spark, sf_dir):
    """Tag each benchmark token from a (word, tag) table; the table here is
    each corpus word's majority language (ties: smallest code); words
    outside it get the default tag ``x``."""
    d = read_table(spark, sf_dir, "documents", "text", "lang")
    words = d.select(explode_values(T.word_tokens("text")).alias("word"), "lang").filter(F.col("word").isNotNull())
    tags = (words.groupBy("word", "lang").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("word").agg(F.min_by("lang", F.struct(-F.col("n"), F.col("lang"))).alias("tag")))
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    toks = (b.select("item_id", posexplode_values(T.word_tokens("text")).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))
    return SG.tag_tokens(toks, "token", tags).select("item_id", "pos", "token", "tag")


@query("x11_x12_segment_urls")
def x11_x12_segment_urls(spark, sf_dir):
    """Dictionary segmentation (precise and search mode) of the letter runs
    in page URLs, with (word, frequency) counted from the documents."""
    d = read_table(spark, sf_dir, "documents", "text")
    dic = (d.select(explode_values(T.word_tokens("text")).alias("word")).filter(F.col("word").isNotNull())
           .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))
    p = read_table(spark, sf_dir, "pages", "page_id", "url")
    runs = (p.select("page_id", explode_values(F.regexp_extract_all(F.lower("url"), F.lit("[a-z]{4,}"), 0)).alias("run"))
            .filter(F.col("run").isNotNull()))
    precise = SG.segment_text(runs, "run", dic)
    search = SG.segment_text(runs.select("run").distinct(), "run", dic, search_mode=True) \
        .select("run", F.col("words").alias("search_words"))
    return (precise.join(search, "run", "left")
            .select("page_id", "run", F.array_join("words", " ").alias("words"),
                    F.array_join("search_words", " ").alias("search_words")))


@query("m03_m10_greedy_tune_refit")
def m03_m10_greedy_tune_refit(spark, sf_dir):
    """Greedy coordinate tuning of boosted trees (depth, then step size),
    every grid point scored by 3-fold held-out loss per round; the chosen
    setting is refit on train + validation (U02) and scores the documents."""
    df = kfold(_doc_features(spark, sf_dir), ["doc_id"], 3)
    x = MD.assemble_for_trees(df, ["log_chars", "word_rate", "digit_rate"]).withColumn("label", F.col("lines"))
    best, log = MD.greedy_tune(x, "fold", [{"maxDepth": [2, 3]}, {"stepSize": [0.1, 0.3]}],
                               "regression", base={"seed": 7}, max_iter=5)
    train, valid = x.filter(F.col("fold") != 0), x.filter(F.col("fold") == 0)
    model = MD.refit(MD.with_label(train), MD.with_label(valid), MD.gbt("regression", maxIter=5, **best))
    return model.transform(x).select("doc_id", F.round("prediction", R).alias("prediction"),
                                     F.lit(MD.json_params(best)).alias("params"))


# ---- models with a closed form, compared with SQL -------------------------------------------
_X = ("l_quantity", "l_discount", "l_tax")


def _det(rows) -> str:
    """3 x 3 determinant as SQL, by the first row."""
    (a, b, c), (d, e, f), (g, h, i) = rows
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_COV = [[f"covar_pop({a}, {b})" for b in _X] for a in _X]
_RIGHT = [f"covar_pop({a}, l_extendedprice)" for a in _X]


def _cramer(k: int) -> str:
    return f"{_det([[_RIGHT[r] if c == k else _COV[r][c] for c in range(3)] for r in range(3)])} / {_det(_COV)}"


@query("f04_linear_weights", "\nUNION ALL ".join(f"SELECT '{c}' AS feature, round({_cramer(k)}, 3) AS weight FROM lineitem" for k, c in enumerate(_X)))
def f04_linear_weights(spark, sf_dir):
    """Least-squares weights with intercept (oracle: Cramer's rule on the covariances)."""
    w = MD.linear_weights(read_table(spark, sf_dir, "lineitem", *_X, "l_extendedprice"), list(_X), "l_extendedprice")
    return spark.createDataFrame(list(w.items()), "feature string, weight double").select("feature", F.round("weight", 3).alias("weight"))


@query("f05_f06_one_feature", """
SELECT round(sign(c) * greatest(abs(c) - 1000, 0) / v, 2) AS lasso, round(c / (v + 1000 / n), 2) AS ridge
FROM (SELECT covar_pop(CAST(l_quantity AS DOUBLE), l_extendedprice) AS c, var_pop(CAST(l_quantity AS DOUBLE)) AS v, count(*) AS n FROM lineitem)
""")
def f05_f06_one_feature(spark, sf_dir):
    """Lasso (alpha 1000) and ridge (alpha 1000) weight of one feature
    (oracle: soft threshold and shrinkage of the covariance)."""
    x = MD.assemble(read_table(spark, sf_dir, "lineitem", "l_quantity", "l_extendedprice").select(F.col("l_quantity").cast("double").alias("q"), F.col("l_extendedprice").alias("label")), ["q"])
    s = x.agg(F.count("*").alias("n"), F.stddev_samp("label").alias("std")).first()
    ridge = MD.ridge(1000.0, s["n"], s["std"]).fit(x).coefficients[0]
    lasso = MD.lasso(1000.0).fit(x).coefficients[0]
    return spark.createDataFrame([(round(float(lasso), 2), round(float(ridge), 2))], "lasso double, ridge double")


@query("m01_m04_m07_group_models", """
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderstatus = 'F'), 2) AS boosted, round(avg(o_totalprice) OVER (PARTITION BY o_orderstatus = 'F'), 2) AS forest,
  round(avg(CASE WHEN o_totalprice > 150000 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY o_orderstatus = 'F'), 3) AS logistic
FROM orders
""")
def m01_m04_m07_group_models(spark, sf_dir):
    """One boosted tree, one unsampled tree and an unpenalised logistic
    regression on a two-valued feature, for every order (oracle: the means
    and rates of the two groups)."""
    from pyspark.ml.functions import vector_to_array
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    x = MD.assemble(o.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("double").alias("f"), F.col("o_totalprice").cast("double").alias("label"),
                             (F.col("o_totalprice") > 150000).cast("double").alias("big")), ["f"])
    boosted = MD.gbt("regression", maxIter=1, maxDepth=1).setPredictionCol("boosted").fit(x)
    forest = MD.random_forest("regression", numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all").setPredictionCol("forest").fit(x)
    logistic = MD.logistic(1e15, 1).setLabelCol("big").setTol(1e-12).setMaxIter(500).fit(x)
    out = logistic.transform(forest.transform(boosted.transform(x)))
    return out.select("o_orderkey", F.round("boosted", 2).alias("boosted"), F.round("forest", 2).alias("forest"), F.round(vector_to_array("probability")[1], 3).alias("logistic"))
