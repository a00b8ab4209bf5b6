"""Whitening against numpy's own decomposition, and the eigenvalue search on its own."""

from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import SF_SMALL as SF
from transitlens.llm import whitening
from transitlens.llm.feast import inertia, largest

SCHEMA = "vec_id long, embedding array<float>, x string, component string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", None) for r in rows], SCHEMA)


def expected(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)) + 100_000
    mean = x.mean(axis=0)
    e, v = np.linalg.eigh((x - mean).T @ (x - mean) / len(x))
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return x.astype(int), mean, e, v


@pytest.mark.parametrize(("n", "k"), [(1, 8), (5, 8), (64, 8), (40, 40)])
def test_largest_eigenpairs(n, k):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((200, n)) @ rng.standard_normal((n, n))
    a = np.atleast_2d(np.cov(x.T, bias=True))
    e, v = largest(a, k)
    assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:k], rtol=1e-9)
    assert np.abs(a @ v - v * e).max() < 1e-13 * e[0] * n
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-11


def test_equal_and_zero_eigenvalues():
    e, v = largest(np.diag([5.0] * 12 + [1.0] * 5 + [0.0] * 20), 8)
    assert np.allclose(e, 5) and np.allclose(v.T @ v, np.eye(8))
    assert np.allclose(largest(np.zeros((3, 3)), 2)[0], 0)


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for _ in range(40):
        m = rng.standard_normal((int(rng.integers(1, 25)),) * 2)
        m, shift = m + m.T, rng.standard_normal()
        assert inertia(m, shift) == (np.linalg.eigvalsh(m) < shift).sum()
    assert inertia(np.eye(3), 1.0) == 0 and inertia(np.zeros((2, 2)), 0.0) == 0
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_rows_match_numpy(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    data = {r.vec_id: list(r.embedding) for r in vectors.collect()}
    x, mean, e, v = expected(list(data.values()))
    index = {i: n for n, i in enumerate(data)}
    got = whitening.whiten(vectors).collect()
    n, s = len(x), x.sum(axis=0)
    assert len(got) == n * 8 and {r.n for r in got} == {n}
    white = np.zeros((n, 8))
    for r in got:
        i = index[r.vec_id]
        white[i, r.component - 1] = r.whitened
        assert r.deviation == ((n * x[i] - s) ** 2).sum()
        assert math.isclose(r.explained, e[r.component - 1] / np.trace((x - mean).T @ (x - mean) / n), rel_tol=1e-9)
    want = (x - mean) @ v / np.sqrt(e)
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-8
    assert np.abs((want * white).mean(axis=0) ** 2 - 1).max() < 1e-8  # one sign for all rows
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    again = whitening.whiten(vectors.repartition(7)).drop("identity_error").collect()
    for a, b in zip(sorted(again), sorted(got), strict=True):
        assert tuple(a)[:4] == tuple(b)[:4] and a.explained == b.explained and a.whitened == pytest.approx(b.whitened, abs=1e-12)


def test_odd_rows(spark):
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, -3.0]), (4, [2.0, 2.0]), (5, [7.5, 0.0])]
    odd = [(6, None), (7, []), (8, [1.0, None]), (9, [math.nan, 1.0]), (10, [math.inf, 1.0]), (11, [1.0]), (12, [1e30, 0.0])]
    got = whitening.whiten(frame(spark, good + odd)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted(
        (i or 0, c) for i, _ in good for c in (1, 2)) and {r.n for r in got} == {5}
    _, mean, e, v = expected([x for _, x in good])
    x4 = np.array([2048, 2048]) + 100_000
    assert sorted(abs(r.whitened) for r in got if r.vec_id == 4) == pytest.approx(sorted(np.abs((x4 - mean) @ v / np.sqrt(e))))


def test_without_variance(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    got = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])).collect()  # one direction only
    assert [(r.component, abs(r.whitened), r.explained) for r in got] == [(1, pytest.approx(1), pytest.approx(1))] * 2


def test_large_entries_and_wide_vectors(spark):
    rows = [(i, [float(i) * 2 ** 45, 1.0, -3.0 * i]) for i in range(4)]  # products far beyond 64 bits
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.n for r in got} == {4} and any(r.deviation is None for r in got)
    assert sorted(r.whitened for r in got if r.component == 1) == pytest.approx([-1.3416407865, -0.4472135955, 0.4472135955, 1.3416407865])
    rng = np.random.default_rng(0)
    wide = [(i, rng.standard_normal(300).tolist()) for i in range(12)]
    got = whitening.whiten(frame(spark, wide)).collect()
    assert len(got) == 96 and got[0].identity_error < 1e-6
