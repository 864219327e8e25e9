"""Whitening against numpy's eigenvectors of the covariance, and exact deviations."""

import math

import numpy as np
import pytest

from tests.llm.conftest import collected
from vaultwright.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def integers(vectors):
    return np.floor(1024 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 100_000


def checked(found, vectors, ids, k):
    """Rows by (vec_id, component), held against brute force."""
    x = integers(vectors)
    n, d = x.shape
    y = x - x.sum(axis=0) / n
    covariance = y.T @ y / n
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1], v[:, ::-1]
    rows = {(r.vec_id, r.component): r for r in found}
    assert len(rows) == len(found) == n * min(k, d)
    sums = x.sum(axis=0).tolist()
    for j in range(min(k, d)):
        whole = np.array([rows[i, j + 1].whitened for i in ids])
        plain = y @ v[:, j] / math.sqrt(e[j])
        sign = 1 if whole @ plain > 0 else -1
        assert np.allclose(whole, sign * plain, atol=1e-7)
        for i, row in zip(ids, x.tolist()):
            r = rows[i, j + 1]
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(row, sums))
            assert r.explained == pytest.approx(e[j] / np.trace(covariance), rel=1e-9) and r.identity_error < 1e-9


@pytest.mark.parametrize("n,d", [(300, 5), (40, 12), (1000, 3)])
def test_random_vectors(spark, n, d):
    rng = np.random.default_rng(n)
    vectors = (rng.normal(size=(n, d)) @ np.diag(2.0 ** -np.arange(d)) @ rng.normal(size=(d, d)) + 5).astype(np.float32)
    df = table(spark, vectors.tolist())
    found = whitening.fit(df)
    checked(whitening.whiten(df, found).collect(), vectors, range(n), 8)
    assert np.abs(found.components.T @ found.components - np.eye(d)).max() < 1e-12


def test_close_to_singular(spark):
    """A condition number whose square no double holds: one Cholesky factor of the Gram matrix would fail."""
    rng = np.random.default_rng(5)
    plain = rng.integers(-(2**30), 2**30, size=(400, 2)) / 1024.0
    vectors = np.column_stack([plain[:, 0], plain[:, 0] + rng.integers(-3, 4, size=400) / 1024.0, plain[:, 1]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = whitening.fit(df)
    x = np.floor(1024 * vectors) + 100_000
    sigma = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert sigma[0] / sigma[-1] > 1e8
    assert np.allclose(np.sqrt(found.eigenvalues * 400), sigma, rtol=1e-5) and found.passes >= 3
    assert whitening.identity_error(df, found, 3) < 1e-4


def test_no_variance_and_repeated_dimensions(spark):
    rng = np.random.default_rng(2)
    one = rng.integers(-2000, 2000, size=(60, 1)) / 1024
    df = table(spark, np.column_stack([one, one, np.full((60, 1), 7.0)]).tolist())
    found = whitening.whiten(df, whitening.fit(df)).collect()
    assert len(found) == 180
    for r in found:
        assert (r.whitened is None) == (r.component > 1) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(1.0 if r.component == 1 else 0.0, abs=1e-9)
    alike = table(spark, [[1.0, 2.0]] * 4, [5, 5, None, 7])
    rows = collected(whitening.whiten(alike, whitening.fit(alike)), "vec_id", "component", "n", "deviation", "whitened", "explained")
    assert rows == sorted([(i, c, 4, 0, None, 0.0) for i in (5, 5, None, 7) for c in (1, 2)], key=repr)


def test_rows_that_are_left_out(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(50, 4)).astype(np.float32).tolist()
    odd = [None, [], [1, None, 2, 3], [1, math.nan, 2, 3], [1, 2, math.inf, 4], [1, 2, -math.inf, 4]]
    df = table(spark, [*vectors, *odd]).selectExpr("*", "'x' AS n", "1 AS component", "2 AS vector")
    checked(whitening.whiten(df, whitening.fit(df)).collect(), vectors, range(50), 8)
    for none in (table(spark, []), table(spark, odd)):
        found = whitening.whiten(none, whitening.fit(none))
        assert found.count() == 0 and found.columns[:4] == ["vec_id", "component", "n", "deviation"]
    with pytest.raises(ValueError, match="one length"):
        whitening.fit(table(spark, [[1, 2], [1, 2, 3]]))
    with pytest.raises(Exception, match="2\\^40"):
        whitening.fit(table(spark, [[1e30, 2], [1, 2]]))


def test_deviations_beyond_64_bits():
    x = np.array([[0, 5], [4, 1]], np.int64)
    assert whitening.deviations(x, 2, np.array([4, 6])) == [16 + 16, 16 + 16]
    far = np.array([[2**33], [-(2**33)], [3]], np.int64)
    sums = far.sum(axis=0)
    exact = [(3 * v - 3) ** 2 for v in far[:, 0].tolist()]
    assert whitening.deviations(far, 3, sums) == [e if e < 2**63 else None for e in exact] == [None, None, 36]


def test_query(spark, data):
    found = queries.op12_whitening(spark, data).collect()
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    checked(found, [r.embedding for r in rows], [r.vec_id for r in rows], 8)
