"""Whitening against a dense eigendecomposition, exact deviations against Python integers."""

import math

import numpy as np
import pytest

from shelfmark.llm import whitening
from shelfmark.llm.queries import LLM_QUERIES

DDL = "vec_id long, embedding array<double>, n int, component string"


def brute(rows, components=16):
    """Expected rows by (vec_id, component) from the covariance itself."""
    sound = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = {i: tuple(math.floor(64 * float(c)) + 1000000 for c in v) for i, v in sound}
    fit = sorted(set(xs.values()))
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    t = np.array([[n * a - b for a, b in zip(x, s, strict=True)] for x in fit], float) / n
    cov = t.T @ t / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = {}
    for i, x in xs.items():
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        white = np.array([n * a - b for a, b in zip(x, s, strict=True)], float) / n @ q / np.sqrt(e)
        for k in range(len(e)):
            out[i, k + 1] = (n, deviation, white[k], e[k] / np.trace(cov))
    return out


def compare(found, expected):
    assert {(r.vec_id, r.component) for r in found} == set(expected) and len(found) == len(expected)
    signs = {}
    for r in sorted(found, key=lambda r: -abs(r.whitened)):
        n, deviation, white, explained = expected[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, deviation)
        sign = signs.setdefault(r.component, math.copysign(1, r.whitened * white))
        assert r.whitened == pytest.approx(sign * white, abs=1e-8)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-10


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = LLM_QUERIES["op12_jacobi_davidson"](spark, small)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
    }
    compare(found.collect(), brute(rows))


def test_unsound_and_repeated_vectors(spark):
    random = np.random.default_rng(3)
    good = (random.standard_normal((60, 5)) * [5, 4, 3, 2, 1]).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, good[0]) for i in range(50)]
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [math.nan] * 5), (904, [math.inf, 0.0, 0.0, 0.0, 0.0]), (905, [1e300] * 5)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], DDL)
    compare(whitening.whiten(df, components=3).collect(), brute(rows, 3))


def test_each_length_for_itself(spark):
    random = np.random.default_rng(4)
    three = [(i, v) for i, v in enumerate(random.standard_normal((40, 3)).tolist())]
    six = [(100 + i, v) for i, v in enumerate(random.standard_normal((30, 6)).tolist())]
    df = spark.createDataFrame([(*r, 1, "x") for r in three + six], DDL)
    found = whitening.whiten(df).collect()
    compare([r for r in found if r.vec_id < 100], brute(three))
    compare([r for r in found if r.vec_id >= 100], brute(six))


def test_no_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (2, [1.0, 2.0], 1, "x"), (None, [1.0, 2.0], 1, "x")], DDL)
    assert whitening.whiten(df).collect() == []
    assert whitening.whiten(df.where("false")).collect() == []
    line = [(i, [float(i), 2.0 * i]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame([(*r, 1, "x") for r in line], DDL)).collect()
    assert {r.component for r in found} == {1} and len(found) == 9


def test_deviation_beyond_a_long():
    big = np.array([[2**40, 3], [-(2**41), 1]], np.int64)
    assert [int(v) for v in whitening.squares(big).to_pylist()] == [2**80 + 9, 2**82 + 1]


@pytest.mark.parametrize("d", [40, 300])
def test_eigenpairs_to_double_precision(d):
    """A slowly falling spectrum with a repeated eigenvalue, far larger than the subspace."""
    random = np.random.default_rng(d)
    q = np.linalg.qr(random.standard_normal((d, d)))[0]
    e = 1.0 / np.arange(1, d + 1) ** 0.7
    e[3] = e[4]
    matrix = (q * e) @ q.T
    columns = []

    def product(w):
        columns.append(w.shape[1])
        return matrix @ w

    values, vectors, residuals = whitening.jacobi_davidson(product, d, 16)
    assert np.allclose(values, np.sort(e)[::-1][:16], rtol=0, atol=1e-13)
    assert residuals.max() < 1e-13 and np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
    assert max(columns) <= 32 and len(columns) < 90


def test_minres_solves_the_projected_equation():
    random = np.random.default_rng(1)
    q = np.linalg.qr(random.standard_normal((30, 30)))[0]
    matrix = (q * np.arange(1.0, 31.0)) @ q.T
    basis, r = q[:, -2:], random.standard_normal((30, 2))
    r -= basis @ (basis.T @ r)
    values = np.array([29.5, 28.6])
    t = whitening.minres(lambda w: matrix @ w, values, r, basis, 60, 1e-12)
    left = matrix @ t - t * values
    assert np.abs(basis.T @ t).max() < 1e-10
    assert np.abs(left - basis @ (basis.T @ left) + r).max() < 1e-8
