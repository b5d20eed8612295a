import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component string"


def table(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 5, "x") for i, v in zip(ids or range(len(vectors)), vectors)], SCHEMA)


@pytest.mark.parametrize("d", [1, 2, 3, 8, 40])
def test_leading_pairs_equal_a_direct_solver(d):
    a = np.random.default_rng(d).standard_normal((d, d))
    m = a @ a.T
    values, vectors = eigen.leading_pairs(m, 8)
    want = np.linalg.eigvalsh(m)[::-1][:8]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-12 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(m @ vectors, vectors * values, atol=1e-11 * want[0])


@pytest.mark.parametrize("m", [np.eye(9) * 3, np.diag([5., 5, 5, 1, 1, 0]), np.kron(np.eye(6), np.ones((4, 4)))])
def test_equal_eigenvalues_give_orthogonal_vectors(m):
    values, vectors = eigen.leading_pairs(m, 8)
    assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:8], atol=1e-12)
    some = values > 1e-9
    assert np.allclose((vectors.T @ vectors)[np.ix_(some, some)], np.eye(some.sum()), atol=1e-10)
    assert np.allclose(m @ vectors, vectors * values, atol=1e-10)


def test_sturm_counts():
    diagonal, off = np.array([4., 3, 2, 1]), np.array([1., .5, 0])
    want = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    for at in (-1., .9, 1.1, 2.5, 10.):
        assert eigen.sturm_counts(diagonal, off, np.array([at]))[0] == (want < at).sum()


def test_whitened_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    good = (rng.standard_normal((300, 12)) * np.arange(1, 13) + 5).tolist()
    good[7] = good[8]  # repeated vectors, and a common one
    good[100:200] = [good[100]] * 100
    odd = [None, [], [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1e300] * 12, [1.0] * 5]
    found = whitening.whiten(table(spark, good + odd), components=8).toPandas()
    x = np.floor(1024 * np.array(good)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    want = (x - s / n) @ axes[:, :8] / np.sqrt(values[:8])
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[range(n)].to_numpy()
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-9)
    assert np.allclose(np.abs(got.T @ want) / n, np.eye(8), atol=1e-9)  # one sign for all rows
    one = found[found.component == 1].set_index("vec_id").loc[range(n)]
    assert (one.deviation.to_numpy() == ((n * x - s) ** 2).sum(axis=1)).all()
    share = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(share, values[:8] / values.sum(), rtol=1e-10)
    assert set(found.n) == {n} and found.identity_error.nunique() == 1 and found.identity_error.iloc[0] < 1e-9
    assert list(found.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_odd_tables(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [None, [float("nan")]])).count() == 0
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0  # no variance
    two = whitening.whiten(table(spark, [[1.0, 2.0], [3.0, 1.0], [0.0, 0.0]], ids=[1, 1, None])).toPandas()
    assert sorted(two.component) == [1, 1, 1, 2, 2, 2] and two.vec_id.isna().sum() == 2
    flat = whitening.whiten(table(spark, [[1.0, 2.0], [2.0, 4.0], [3.0, 6.0]]))
    assert {r[0] for r in flat.select("component").collect()} == {1}  # one direction only


def test_deviations_beyond_a_long_are_null():
    x = np.array([[0], [1 << 40]], np.int64)
    assert whitening._deviations(x, 1 << 20, [1 << 60]) == [None, 0]
    assert whitening._deviations(np.array([[3], [5]], np.int64), 2, [8]) == [4, 4]


def test_covariance_is_summed_over_many_tasks(spark):
    vectors = np.random.default_rng(1).standard_normal((500, 6)).tolist()
    one = whitening.whiten(table(spark, vectors).coalesce(1)).agg(F.max("explained")).first()[0]
    many = whitening.whiten(table(spark, vectors).repartition(13)).agg(F.max("explained")).first()[0]
    assert abs(one - many) < 1e-12
