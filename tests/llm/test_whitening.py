"""Whitening by shifted CholeskyQR against numpy's eigenvectors."""

import numpy as np
import pytest

from staylake.llm import whitening
from tests.llm.helpers import HAVE_TABLES, SF

SCHEMA = "vec_id long, embedding array<double>, x int, n long, component int"


def _run(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vectors], SCHEMA)
    grid = whitening.grid_vectors(df, "vec_id", "embedding")
    return whitening.whiten(grid, whitening.fit(grid)).collect()


def _plain(x):
    """Eigenvalues, eigenvectors and mean of the distinct rows."""
    distinct = np.unique(x, axis=0)
    mean = distinct.sum(0) / len(distinct)
    centred = distinct - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / len(distinct))
    return values[::-1], vectors[:, ::-1], mean, distinct


def _compare(rows, ids, x, rtol=1e-7):
    values, vectors, mean, distinct = _plain(x.astype(np.float64))
    n, sums = len(distinct), [int(s) for s in np.unique(x, axis=0).sum(0)]
    k = min(4, x.shape[1])
    assert len(rows) == len(ids) * k
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-6)
        assert r["identity_error"] <= 1e-9
    for c in range(k):
        want = (x - mean) @ vectors[:, c] / np.sqrt(values[c])
        have = np.array([got[i][c + 1]["whitened"] for i in ids])
        sign = np.sign(want @ have)
        np.testing.assert_allclose(sign * have, want, rtol=rtol, atol=rtol * 10)
    for i, row in zip(ids, x.tolist()):
        assert got[i][1]["deviation"] == sum((n * a - s) ** 2 for a, s in zip(row, sums))


@pytest.mark.parametrize("spread", [[8, 4, 2, 1, 0.5, 0.25], [1000, 900, 1, 0.5, 0.01, 0.01]])
def test_equals_the_eigenvectors_of_the_covariance(spark, spread):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    c = (rng.normal(size=(400, 6)) * spread) @ turn + 5000.0
    c[50:90] = c[50]  # one vector on many rows counts once in the fit
    rows = _run(spark, [(n, v.tolist()) for n, v in enumerate(c)])
    _compare(rows, list(range(400)), np.floor(256 * c).astype(np.int64))


def test_nearly_dependent_columns(spark):
    rng = np.random.default_rng(4)
    c = rng.normal(size=(300, 3)) * [4e6, 2e6, 1e6]
    c = np.hstack([c, c.sum(1, keepdims=True) + rng.normal(size=(300, 1)) * 0.05])
    df = spark.createDataFrame([(n, v.tolist(), 1, 2, 3) for n, v in enumerate(c)], SCHEMA)
    grid = whitening.grid_vectors(df, "vec_id", "embedding")
    model = whitening.fit(grid)
    assert len(model.factors) >= 2
    x = np.floor(256 * c)
    sigma = np.linalg.svd(x - x.mean(0), compute_uv=False)
    np.testing.assert_allclose(np.sqrt(model.eigenvalues * 300), sigma, rtol=1e-6)
    assert model.identity_error < 1e-4


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_given_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    grid = whitening.grid_vectors(df, "vec_id", "embedding")
    held = grid.collect()
    rows = whitening.whiten(grid, whitening.fit(grid)).collect()
    _compare(rows, [r["vid"] for r in held], np.array([r["x"] for r in held]))


def test_unusable_vectors_take_no_part(spark):
    rows = _run(spark, [(1, [1.0, 0.0]), (2, [0.0, 3.0]), (3, None), (4, [None, 1.0]),
                        (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [2.0, 2.0]),
                        (7, [1.0, 0.0])])
    assert sorted({r["vec_id"] for r in rows}, key=str) == [1, 2, 7, None]
    assert {r["n"] for r in rows} == {3}


def test_directions_without_variance(spark):
    rows = _run(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 7.0])])
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert by[1, 2]["whitened"] is None and by[1, 2]["explained"] == 0.0
    assert by[1, 1]["explained"] == pytest.approx(1.0) and by[1, 1]["identity_error"] < 1e-9
    rows = _run(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"])
            for r in rows} == {(1, 0, None, None, None)}
    assert len(rows) == 4


def test_empty_tables_and_lengths(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, [])]) == []
    rows = _run(spark, [(1, []), (2, [1.0]), (3, [1.0, 0.0]), (4, [1.0, 2.0])])
    assert {r["n"] for r in rows} == {3}  # (1) and (1, 0) are one vector
    assert len(rows) == 8


def test_huge_entries(spark):
    rows = _run(spark, [(1, [1e300, 1.0]), (2, [5e7, -1e300]), (3, [1.0, 2.0]), (4, [2.0, 1.0])])
    assert {r["deviation"] for r in rows} == {None}
    assert all(np.isfinite(r["whitened"]) for r in rows)
