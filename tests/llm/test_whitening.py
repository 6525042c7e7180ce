"""Whitening against a dense eigensolver and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from eventlode.llm.whitening import inertia, largest_eigenpairs, moments, op13_feast_whitening, whiten


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 64, 64), np.geomspace(1e-9, 1e3, 64), np.r_[np.ones(40), np.full(24, 7.0)], np.r_[np.zeros(60), 1, 2, 3, 4],
    np.r_[np.full(30, 2.0), np.full(30, 2.0 + 1e-13), 5, 6, 7, 8], np.r_[np.zeros(63), 9.0], np.array([3.0]), np.ones(20),
    np.r_[np.linspace(1, 1.001, 50), 500.0, 1e6]])
def test_eigenpairs(values):
    a = spectrum(values)
    got, vectors = largest_eigenpairs(a, 16)
    want = [v for v in sorted(values, reverse=True)[:16] if v > 1e-10 * max(values)]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12 * max(values)) and len(got) == len(want)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-12 * max(values)


def test_inertia():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        for s in (-3, -0.1, 0, 0.2, 2.5):
            assert inertia(a, s) == int((np.linalg.eigvalsh(a) > s).sum())
    assert inertia(np.array([[0.0, 1], [1, 0]]), 0) == 1 and inertia(np.zeros((4, 4)), 0) == 0
    assert largest_eigenpairs(np.zeros((3, 3)), 2)[0].size == 0


def by_hand(rows, k=16):
    """vec_id -> (n, deviation, projections' squares) from exact integers and numpy's dense solver."""
    rows = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    z = np.array([[float(Fraction(x[j] * n - sums[j], n)) for j in range(d)] for x in fit])
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, x in rows:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out.append((i, n, dev, np.array([float(Fraction(a * n - s, n)) for a, s in zip(x, sums, strict=True)]) @ u / np.sqrt(e)))
    return out, e / np.trace(v)


def test_query(spark, sf_dir):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
             if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    want, explained = by_hand(given)
    found = {}
    for r in op13_feast_whitening(spark, sf_dir).collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    assert len(found) == len(want)
    signs = None
    for i, n, dev, w in want:
        rows = [found[i][c] for c in range(1, 17)]
        got = np.array([r.whitened for r in rows])
        if signs is None:
            signs = np.sign(got) * np.sign(w)
        assert all(r.n == n and r.deviation == dev and r.identity_error < 1e-9 for r in rows)
        assert np.allclose(got * signs, w, atol=1e-7)
        assert np.allclose([r.explained for r in rows], explained, rtol=1e-10)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(k, rng.standard_normal(5).tolist(), 1) for k in range(40)]
    bad = [(100, None, 1), (101, [1.0, None, 0.0, 0.0, 0.0], 1), (102, [math.nan] * 5, 1), (103, [math.inf, 0.0, 0.0, 0.0, 0.0], 1), (104, [1.0], 1),
           (105, [], 1), (106, [1e300, 0.0, 0.0, 0.0, 0.0], 1)]
    again = good[:7] + [(None, good[0][1], 1)]
    schema = "vec_id long, embedding array<double>, n int"
    rows = whiten(spark.createDataFrame(good + bad + again, schema)).collect()
    assert sorted(str(r.vec_id) for r in rows) == sorted(str(r[0]) for r in good + again)
    want, _ = by_hand([r[:2] for r in good])
    assert {(r.vec_id, r.n, r.deviation) for r in rows if r.vec_id is not None} == {x[:3] for x in want}
    assert all(len(r.whitened) == 5 and r.identity_error < 1e-9 for r in rows)
    empty = spark.createDataFrame([], schema)
    assert whiten(empty).count() == 0 and whiten(spark.createDataFrame(bad[:4], schema)).count() == 0
    same = whiten(spark.createDataFrame([(k, [1.0, 2.0], 0) for k in range(9)], schema)).collect()
    assert len(same) == 9 and all(r.whitened == [] and r.deviation == 0 and r.n == 1 for r in same)


def test_large_entries_are_exact(spark):
    rows = [(k, [float((k * 7919) % 1000) * 1e9, float(k)]) for k in range(50)]
    want, _ = by_hand(rows)
    found = {r.vec_id: r for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for i, n, dev, w in want:
        assert found[i].n == n and found[i].deviation == (dev if dev < 1 << 63 else None)
        # The second eigenvalue is 1e-18 of the first, zero to rounding.
        assert np.allclose(np.abs(found[i].whitened), np.abs(w[:1]), atol=1e-6)


def test_moments_are_exact(spark):
    fit = spark.createDataFrame([([2**51 + k, -k],) for k in range(3000)], "x array<long>")
    n, sums = moments(fit)
    assert (n, sums) == (3000, [3000 * 2**51 + 2999 * 1500, -2999 * 1500])
