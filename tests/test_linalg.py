"""Blocked products and QR trees against numpy."""

import numpy as np
import pytest

from featlab.operators import linalg as L


def coords(spark, x, parts=3):
    rows = [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return spark.createDataFrame(rows, "i long, j long, v double").repartition(parts)


def dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.i, r.j] += r.v
    return out


def rows_of(spark, x, parts=4):
    return spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "id long, x array<double>").repartition(parts)


@pytest.mark.parametrize("ta,tb", [(False, False), (True, False), (False, True), (True, True)])
def test_blocked_product(spark, ta, tb):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(23, 9)), rng.normal(size=(9, 14))
    a[rng.random(a.shape) < .4] = 0
    a[:, 3] = 0
    got = L.matmul(coords(spark, a.T if ta else a), coords(spark, b.T if tb else b), ta, tb, size=4)
    assert np.allclose(dense(got, (23, 14)), a @ b)


def test_a_dense_inner_index_is_split_and_sums_are_handed_over(spark, monkeypatch):
    rng = np.random.default_rng(3)
    a, b = np.zeros((90, 6)), np.zeros((6, 50))
    a[:, 2], b[2] = rng.normal(size=90), rng.normal(size=50)  # one inner index holds everything
    monkeypatch.setattr(L, "GROUP_BLOCKS", 5)
    product = L.blocks_product(L.blocks(coords(spark, a), 2), L.blocks(coords(spark, b), 2))
    assert np.allclose(dense(L.coordinates(product, 2), (90, 50)), a @ b)
    plan = L.blocks(coords(spark, a), 2).groupBy("bj").count().collect()
    assert [r["count"] for r in plan] == [45]


def test_repeated_places_nulls_and_empty_products(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 0, None), (5, 1, 4.0)], "i long, j long, v double")
    assert np.allclose(dense(L.matmul(df, df, transpose_a=True, size=2), (2, 2)), [[9, 0], [0, 16]])
    assert L.matmul(df.limit(0), df).count() == 0


def test_qr_of_many_partitions(spark):
    x = np.random.default_rng(4).normal(size=(300, 7))
    for parts in (1, 40):  # 40: several levels of the tree
        r = L.tall_skinny_qr(rows_of(spark, x, parts), "x")
        assert np.allclose(r, np.triu(r)) and (np.diag(r) > 0).all() and np.allclose(r.T @ r, x.T @ x)
    q = {k.id: k.q for k in L.orthonormal_rows(rows_of(spark, x), "x", r).collect()}
    q = np.array([q[k] for k in range(len(x))])
    assert np.allclose(q.T @ q, np.eye(7)) and np.allclose(q @ r, x)


def test_dependent_columns_and_small_singular_values(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 50))
    x = np.stack([a, 2 * a, b, a - b], 1)
    r = L.tall_skinny_qr(rows_of(spark, x), "x")
    assert np.allclose(r.T @ r, x.T @ x) and (r[2:] == 0).all() and np.allclose(r, np.triu(r))
    tiny = np.array([[1.0, 1.0], [1e-9, 0.0], [0.0, 1e-9]])
    values, right = L.svd(rows_of(spark, tiny, 1), "x")
    want = np.linalg.svd(tiny)
    assert values == pytest.approx(want[1], rel=1e-6) and values[1] == pytest.approx(1e-9, rel=1e-6)
    assert np.allclose(np.abs(right), np.abs(want[2].T))
    assert (L.tall_skinny_qr(rows_of(spark, np.zeros((3, 2))), "x") == 0).all()
    assert L.tall_skinny_qr(rows_of(spark, np.ones((1, 2))), "x").tolist() == [[1, 1], [0, 0]]


def test_least_squares_of_a_badly_scaled_matrix(spark):
    rng = np.random.default_rng(6)
    t = rng.random(200)
    x = np.stack([np.ones(200), t, t + 1e-7 * rng.normal(size=200)], 1)
    y = x @ [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    assert L.least_squares(df, ["a", "b", "c"], "y") == pytest.approx([1, 2, 3], abs=1e-6)  # normal equations lose all digits here
    assert L.least_squares(df.limit(0), ["a"], "y").tolist() == [0.0]


def test_ragged_and_empty_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "id long, x array<double>")
    for run in (L.gram_matrix, L.tall_skinny_qr, L.svd):
        with pytest.raises(ValueError, match="1 to 2"):
            run(df, "x")
    odd = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, None]), (2, None)], "id long, x array<double>")
    assert np.allclose(L.tall_skinny_qr(odd, "x"), [[1, 2], [0, 0]])
    assert [r.q for r in L.orthonormal_rows(odd, "x", np.eye(2)).orderBy("id").collect()] == [[1.0, 2.0], None, None]
    assert L.tall_skinny_qr(odd.limit(0), "x").shape == (0, 0) and L.gram_matrix(odd.limit(0), "x").count() == 0
