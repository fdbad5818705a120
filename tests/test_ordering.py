"""Global rank, folds and hot-key chunked windows against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featlab.operators import sequential as S
from featlab.operators.folds import batches, kfold, stratified_kfold
from featlab.operators.ordering import global_rank


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_global_rank_partition_invariant(spark, parts):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id"))
    r = global_rank(df, ["k", "id"], "rk", num_partitions=parts).toPandas().sort_values(["k", "id"])
    assert r["rk"].tolist() == list(range(1, 1001))


def test_global_rank_hot_group(spark):
    # one group holds a third of the rows; ranks restart per group
    df = spark.range(0, 900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7 + 1).alias("g"), "id")
    r = global_rank(df, ["id"], "rk", partition_by=["g"], num_partitions=6, size_col="n").toPandas()
    for g, grp in r.groupby("g"):
        assert sorted(grp["rk"]) == list(range(1, len(grp) + 1))
        assert (grp.sort_values("id")["rk"].diff().dropna() == 1).all()
        assert (grp["n"] == len(grp)).all()


def test_kfold_sizes_and_blocks(spark):
    df = spark.range(0, 103)
    f = kfold(df, ["id"], 5).toPandas().sort_values("id")
    sizes = f.groupby("fold").size().tolist()
    assert sizes == [21, 21, 21, 20, 20]
    assert (f["fold"].diff().dropna() >= 0).all()


def test_stratified_folds_balanced(spark):
    df = spark.range(0, 500).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    f = stratified_kfold(df, "y", ["id"], 5).toPandas()
    for _, grp in f.groupby("y"):
        s = grp.groupby("fold").size()
        assert s.max() - s.min() <= 1


def test_batches_drop_remainder(spark):
    df = spark.range(0, 70)
    b = batches(df, ["id"], 16, drop_remainder=True).toPandas()
    assert len(b) == 64 and b["batch"].max() == 3


def _series(n=400, keys=3, seed=1):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"k": rng.integers(0, keys, n), "t": np.arange(n), "v": rng.normal(size=n).round(3)})


def test_cumsum_chunks_match_pandas(spark):
    pdf = _series()
    df = spark.createDataFrame(pdf)
    out = S.cumulative_sum(df, ["k"], ["t"], "v", chunk_rows=7).toPandas().sort_values("t")
    exp = pdf.sort_values("t").groupby("k")["v"].cumsum()
    np.testing.assert_allclose(out["cumsum"].to_numpy(), exp.sort_index().to_numpy(), atol=1e-9)
    tot = pdf.groupby("k")["v"].transform("sum").sort_index().to_numpy()
    np.testing.assert_allclose(out["cumsum_rev"].to_numpy(), tot - exp.sort_index().to_numpy() + pdf["v"].to_numpy(), atol=1e-9)


def test_sliding_with_halo_matches_pandas(spark):
    pdf = _series()
    df = spark.createDataFrame(pdf)
    out = S.moving_average(df, ["k"], ["t"], "v", 5, chunk_rows=6).toPandas().set_index("t")["moving_avg"]
    exp = pdf.groupby("k")["v"].rolling(5).mean().reset_index(level=0, drop=True).dropna()
    np.testing.assert_allclose(out.sort_index().to_numpy(), exp.sort_index().to_numpy(), atol=1e-9)
    rng = S.sliding_range(df, ["k"], ["t"], "v", 20, chunk_rows=25).toPandas().set_index("t")
    mx = pdf.groupby("k")["v"].rolling(20, min_periods=1).max().reset_index(level=0, drop=True)
    np.testing.assert_allclose(rng["max_v"].sort_index().to_numpy(), mx.sort_index().to_numpy())


def test_context_window_chunks(spark):
    pdf = pd.DataFrame({"d": [0] * 30 + [1] * 5, "p": list(range(30)) + list(range(5)),
                        "w": [f"w{i}" for i in range(35)]})
    out = S.context_window(spark.createDataFrame(pdf), ["d"], ["p"], "w", 2, chunk_rows=4).toPandas()
    row = out[(out.d == 0) & (out.p == 8)].iloc[0]
    assert (row.ctx_m1, row.ctx_m2, row.ctx_p1, row.ctx_p2) == ("w7", "w6", "w9", "w10")
    last = out[(out.d == 1) & (out.p == 4)].iloc[0]
    assert last.ctx_p1 is None and last.ctx_m1 == "w33"


def test_ema_chunked_matches_recursion(spark):
    pdf = _series(n=300, keys=2)
    out = S.ema(spark.createDataFrame(pdf), ["k"], ["t"], "v", beta=0.9, chunk_rows=11).toPandas().set_index("t")
    exp = {}
    for _, g in pdf.groupby("k"):
        m = 0.0
        for t, v in zip(g.t, g.v):
            m = 0.9 * m + 0.1 * v
            exp[t] = m
    np.testing.assert_allclose(out["ema"].sort_index().to_numpy(), pd.Series(exp).sort_index().to_numpy(), atol=1e-9)


def test_cumsum_fixture(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 4.0)], "pos int, v double")
    r = S.cumulative_sum(df, [], ["pos"], "v").orderBy("pos").collect()
    assert [x.cumsum for x in r] == [1, 3, 7]
    assert [x.cumsum_excl for x in r] == [0, 1, 3]
    assert [x.cumsum_rev for x in r] == [7, 6, 4]
    assert [x.cumsum_rev_excl for x in r] == [6, 4, 0]


def test_gini_perfect_order(spark):
    pdf = pd.DataFrame({"id": range(50), "a": np.arange(50, dtype=float)})
    pdf["p"] = pdf["a"]
    g = S.gini_normalized(spark.createDataFrame(pdf), "a", "p", "id").first()
    assert abs(g.gini_norm - 1.0) < 1e-12


def test_early_stop(spark):
    log = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 4, 3, 2, 1, 1.5, 2, 2.5, 3, 3.5, 4])],
                                "round int, loss double").withColumn("run", F.lit(1))
    r = S.early_stop(log, ["run"], "round", "loss", patience=4, min_rounds=5).first()
    assert r.best_round == 4 and r.stop_round == 8


@pytest.mark.parametrize("parts", [1, 5, 17])
def test_dense_rank_ids_hot_key_spans_partitions(spark, parts):
    from featlab.operators.ordering import dense_rank_ids
    rows = [("m", i) for i in range(300)] + [(f"k{i % 40:02d}", 1000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "term string, doc long")
    got = dense_rank_ids(df, "term", ["doc"], "tid", num_partitions=parts).toPandas()
    exp = {t: i for i, t in enumerate(sorted({r[0] for r in rows}))}
    assert len(got) == len(rows)
    assert (got["tid"] == got["term"].map(exp)).all()


def test_ema_bounded_carry_window(spark):
    # beta = 0.5 with 100-row chunks: only the last 12 chunks can contribute
    rng = np.random.default_rng(4)
    n = 5000
    pdf = pd.DataFrame({"k": np.zeros(n, dtype=int), "t": np.arange(n), "v": rng.normal(size=n)})
    out = S.ema(spark.createDataFrame(pdf), ["k"], ["t"], "v", beta=0.5, chunk_rows=100).toPandas()
    m, exp = 0.0, []
    for v in pdf.v:
        m = 0.5 * m + 0.5 * v
        exp.append(m)
    np.testing.assert_allclose(out.sort_values("t")["ema"].to_numpy(), np.array(exp), rtol=1e-12, atol=1e-12)


def test_edge_cases_empty_and_tiny(spark):
    from featlab.operators.ordering import dense_rank_ids
    empty = spark.range(0, 0).select(F.col("id"), F.lit("a").alias("t"))
    assert global_rank(empty, ["id"], "rk").count() == 0
    assert dense_rank_ids(empty, "t", ["id"], "tid").count() == 0
    assert S.cumulative_sum(empty.withColumn("v", F.lit(1.0)), [], ["id"], "v").count() == 0
    tiny = kfold(spark.range(0, 3), ["id"], 5).toPandas().sort_values("id")
    assert tiny["fold"].tolist() == [0, 1, 2]


@pytest.mark.parametrize("rows", [40, 1 << 20])
def test_packed_dense_ranks(spark, monkeypatch, rows):
    """Keys of many rows, an id that is NULL, rows that come twice, non-ASCII keys in byte order; the shuffle holds packed blocks."""
    from featlab.operators import ordering as O
    monkeypatch.setattr(O, "PACK_ROWS", rows)
    rng = np.random.default_rng(2)
    terms = ["the", "é", "z", "", "a b", "a", *[f"w{i}" for i in range(30)]]
    data = [(int(i) if i else None, "the" if i % 3 == 0 else terms[rng.integers(len(terms))], int(i % 4)) for i in range(400)]
    data += data[:7]
    df = spark.createDataFrame(data, "doc long, term string, count long").repartition(5)
    sent, plain = [], O.written_table
    monkeypatch.setattr(O, "written_table", lambda d: sent.append(d._jdf.queryExecution().optimizedPlan().toString()) or plain(d))
    got = O.packed_dense_rank_ids(df, "term", F.xxhash64("doc"), "tid")
    assert "Repartition" in sent[-1] and "RepartitionByExpression [pid" in sent[-1]
    rank = {t: k for k, t in enumerate(sorted({t for _, t, _ in data}, key=lambda t: t.encode()))}
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc, r.term, r["count"], r.tid) for r in got.collect()), key=key) == sorted(((d, t, c, rank[t]) for d, t, c in data), key=key)
    assert O.packed_dense_rank_ids(df.limit(0), "term", F.xxhash64("doc"), "tid").count() == 0
