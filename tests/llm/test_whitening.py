from __future__ import annotations

import math

import numpy as np
import pytest
from tidepanel.llm import queries, whitening


def plain(vectors):
    """Grid, fit list, exact deviations and eigenvalues with numpy on one machine."""
    rows = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    deviations = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in rows]
    places = {i: np.array([(n * a - s) / n for a, s in zip(x, sums)]) for i, x in rows}
    return n, cov, deviations, places


def check(rows, vectors, most=16):
    n, cov, deviations, places = plain(vectors)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:most], basis[:, ::-1][:, :most]
    by = {(r.vec_id, r.component): r for r in rows}
    k = max(c for _, c in by)
    assert len(rows) == len(by) == len(places) * k
    assert all(r.n == n and r.identity_error <= 1e-4 for r in rows)
    assert {(r.vec_id, r.deviation) for r in rows} == set(deviations)
    for c in range(1, k + 1):
        share = {r.explained for r in rows if r.component == c}
        assert len(share) == 1 and abs(share.pop() / (values[c - 1] / np.trace(cov)) - 1) < 1e-9
        gap = min([abs(values[c - 1] - v) for i, v in enumerate(values) if i != c - 1], default=values[c - 1]) / values[0]
        if gap > 1e-6:
            got = np.array([by[i, c].whitened for i in places])
            want = np.array([p @ basis[:, c - 1] for p in places.values()]) / math.sqrt(values[c - 1])
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8 / gap
    return k


def test_whole_table(spark, sf_dir):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert check(queries.op12_embedding_whitening(spark, sf_dir).collect(), vectors) == 16


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", [i]) for i, v in vectors], "vec_id long, embedding array<double>, id string, x array<long>")


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    vectors += [(40 + i, vectors[0][1]) for i in range(30)]  # repeated
    vectors += [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [math.nan] * 5), (103, [math.inf] + [0.0] * 4), (104, [0.0] * 5), (105, [-0.001] * 5)]
    odd = [(200, [1.0, 2.0]), (201, []), (202, [1e300] * 5)]
    rows = whitening.whitened(frame(spark, vectors + odd)).collect()
    assert check(rows, vectors) == 5
    assert whitening.whitened(frame(spark, vectors).limit(0)).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whitened(frame(spark, [(None, [1.0, 2.0]), (None, [5.0, 2.0])])).count() == 2  # of rank 1
    assert check(whitening.whitened(frame(spark, vectors), components=2).collect(), vectors, 2) == 2


def test_many_parts_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 7)
    rng = np.random.default_rng(5)
    vectors = [(i, (rng.normal(size=3) * 1e9).tolist()) for i in range(200)]
    got = whitening.whitened(frame(spark, vectors).repartition(13)).collect()
    n, _, deviations, _ = plain(vectors)
    assert {(r.vec_id, r.deviation) for r in got} == {(i, d if d < 1 << 63 else None) for i, d in deviations}
    assert all(r.identity_error < 1e-9 for r in got) and len(got) == 600


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_bidiagonal_form(d):
    r = np.triu(np.random.default_rng(d).normal(size=(d, d)))
    a, b, v = whitening.bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(d), atol=1e-13)
    t = np.diag(a * a)
    t[range(1, d), range(1, d)] += b * b
    t += np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    assert np.allclose(v.T @ r.T @ r @ v, t, atol=1e-11)


@pytest.mark.parametrize("kind", ["random", "graded", "equal", "clusters", "low rank", "one", "glued"])
def test_singular_values_and_directions(kind):
    rng = np.random.default_rng(8)
    d = 40
    values = {
        "random": rng.uniform(0.1, 9, d),
        "graded": 10.0 ** -np.linspace(0, 9, d),
        "equal": np.full(d, 3.0),
        "clusters": np.repeat([5.0, 5.0 + 1e-9, 2.0, 1.0], 10) * (1 + 1e-13 * rng.normal(size=d)),
        "low rank": np.r_[rng.uniform(1, 2, 7), np.zeros(d - 7)],
        "one": np.r_[4.0, np.zeros(d - 1)],
        "glued": np.repeat(np.arange(1.0, 9), 5) + 1e-7 * rng.normal(size=d),
    }[kind]
    u, w = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    r = np.linalg.qr(u * values @ w.T, mode="r")
    squares, made = whitening.directions(r)
    want = np.sort(values**2)[::-1][:16]
    want = want[want > 0]
    assert len(squares) == len(want) and np.allclose(squares, want, rtol=1e-9)
    assert np.abs(made.T @ made - np.eye(len(want))).max() < 1e-9
    assert np.abs(r.T @ (r @ made) - made * squares).max() < 1e-11 * want[0]


def test_values_of_bidiagonals_to_the_last_digits():
    """Small singular values keep their relative accuracy, which a covariance would lose."""
    a, b = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0) / 3
    from fractions import Fraction

    got = whitening.dqds(a * a, b * b)
    product = Fraction(1)
    for x in a * a:
        product *= Fraction(float(x))
    made = Fraction(1)
    for x in got:
        made *= Fraction(float(x))
    assert abs(float(made / product) - 1) < 1e-12  # the determinant, over 276 powers of ten


def test_close_neighbours_within_a_block():
    """A Wilkinson matrix: unreduced, with pairs of eigenvalues that agree to all digits."""
    n = 21
    t = np.diag(np.abs(np.arange(n) - 10.0)) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1) + 3 * np.eye(n)
    r = np.linalg.cholesky(t).T
    squares, made = whitening.directions(r, n)
    assert np.allclose(squares, np.linalg.eigvalsh(t)[::-1], rtol=1e-12)
    assert np.abs(made.T @ made - np.eye(n)).max() < 1e-9 and np.abs(t @ made - made * squares).max() < 1e-8
