"""Pruned top-k search against the plain numpy ranking: clusters, copies, zero vectors, small tables."""

import numpy as np
import pandas as pd
import pytest

from featlab.operators.pruned_search import cell_visits, topk_pruned


def ranking(ids, x, k):
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    s = u @ u.T
    np.fill_diagonal(s, -np.inf)
    want = {}
    for q in range(len(ids)):
        order = np.lexsort((ids, -np.round(s[q], 12)))[:k]
        want[int(ids[q])] = [(int(ids[j]), s[q, j]) for j in order if np.isfinite(s[q, j])]
    return want


def compare(spark, ids, x, k, block_bytes):
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "v": list(x)}))
    got = topk_pruned(df, "id", "v", k=k, block_bytes=block_bytes).toPandas().sort_values(["query_id", "rank"])
    want = ranking(ids, x, k)
    assert len(got) == sum(len(v) for v in want.values())
    for q, g in got.groupby("query_id"):
        assert g["rank"].tolist() == list(range(1, len(g) + 1))
        np.testing.assert_allclose(g.sim.to_numpy(), [s for _, s in want[q]], atol=1e-12)
        assert sorted(g.other_id) == sorted(i for i, _ in want[q]) or pytest.fail(f"query {q}")
    return df


def test_clusters_copies_and_zero_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    x = np.concatenate([centres[rng.integers(0, 6, 400)] + 0.05 * rng.normal(size=(400, 16)),
                        np.tile(np.eye(1, 16), (150, 1)),             # a quarter are copies of one vector
                        np.zeros((3, 16)), rng.normal(size=(20, 16))])
    ids = rng.permutation(len(x)) * 3
    compare(spark, ids, x, 5, 16 * 8 * 40)


def test_cells_that_cannot_be_near_are_skipped(spark):
    rng = np.random.default_rng(6)
    x = np.repeat(np.eye(8) * 5, 80, axis=0) + 0.05 * rng.normal(size=(640, 8))
    df = compare(spark, np.arange(640), x, 4, 8 * 8 * 32)
    _, blocks, visits, n = cell_visits(df, "id", "v", 4, 8 * 8 * 32)
    sent = visits.join(blocks, "cell").count()
    assert n >= 20 and sent < 0.5 * n * n


@pytest.mark.parametrize("n", [0, 1, 3])
def test_tables_smaller_than_k(spark, n):
    rows = [(i, [float(i + 1), 1.0]) for i in range(n)] + [(10, None), (11, [])]
    got = topk_pruned(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", k=5).collect()
    assert len(got) == n * max(n - 1, 0)


def test_only_zero_vectors(spark):
    df = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(4)], "id long, v array<double>")
    got = sorted((r.query_id, r.rank, r.other_id, r.sim) for r in topk_pruned(df, "id", "v", k=2).collect())
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (1, 1, 0, 0.0), (1, 2, 2, 0.0), (2, 1, 0, 0.0), (2, 2, 1, 0.0), (3, 1, 0, 0.0), (3, 2, 1, 0.0)]


def test_vectors_are_not_sent_to_the_blocks_that_see_them(spark, tmp_path):
    """Both searches write each vector once; what they shuffle does not grow with the number of blocks."""
    from featlab.operators import pruned_search as P
    from featlab.operators import vectors as V
    x = np.random.default_rng(9).normal(size=(600, 16))
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(600), "v": list(x)})).repartition(3).cache()
    df.count()
    for search in (V.topk_similar, P.topk_pruned):
        out = search(df, "id", "v", k=3, block_bytes=16 * 8 * 10)   # 60 blocks or more
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "vec" not in plan and "Join" not in plan and out.count() == 1800
    blocks = tmp_path / "blocks"
    listed = V.write_blocks(V.unit_vectors(df, "id", "v"), str(blocks), 16 * 8 * 10).collect()
    assert sum(r.n for r in listed) == 600 and sum(f.stat().st_size for f in blocks.iterdir()) == 600 * 17 * 8 + 16 * len(listed)


def test_rows_without_an_id_are_no_queries(spark):
    from featlab.operators.vectors import topk_similar
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (None, [1.0, 0.1])], "id long, v array<double>")
    for search in (topk_similar, topk_pruned):
        assert sorted((r.query_id, r.other_id) for r in search(df, "id", "v", k=2).collect()) == [(1, 2), (2, 1)]
