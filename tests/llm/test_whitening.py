import math

import numpy as np
import pytest

from wardenlake.llm import whitening
from wardenlake.llm.catalog import op12_whitening
from wardenlake.llm.jacobi_davidson import largest_eigenpairs, minres


def brute(rows):
    """(vectors by id, eigenvalues, eigenvectors, x) in one piece."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(float)) + 100_000
    c = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(c.T @ c / len(c))
    return [i for i, _ in kept], values[::-1], turn[:, ::-1], x


def compare(got, rows, components=8):
    ids, values, turn, x = brute(rows)
    n, k = len(x), min(components, x.shape[1])
    exact = [[int(v) for v in row] for row in x]
    sums = [sum(c) for c in zip(*exact)]
    want = {i: sum((n * v - s) ** 2 for v, s in zip(row, sums)) for i, row in zip(ids, exact)}
    assert len(got) == n * k and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] <= 1e-9
    projected = (x - x.mean(axis=0)) @ turn[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        mine = {r["vec_id"]: r for r in got if r["component"] == c + 1}
        assert all(mine[i]["deviation"] == want[i] for i in ids)
        assert np.allclose([r["explained"] for r in mine.values()], values[c] / values.sum(), rtol=1e-12)
        w = np.array([mine[i]["whitened"] for i in ids])
        sign = np.sign(w @ projected[:, c])
        assert np.allclose(w, sign * projected[:, c], atol=1e-8)


def test_query_matches_a_dense_solver(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    compare(op12_whitening(spark, sf).collect(), rows)


def test_sums_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "SUMS_AT_ONCE", 2)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(6) * 3.0 ** np.arange(6)).astype(np.float32).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    compare(whitening.whitened_components(df).collect(), rows)


def test_odd_rows(spark):
    kind = "vec_id long, embedding array<double>, n int, component string"
    good = [(1, [0.5, 1.0, -2.0]), (2, [0.25, 3.0, 1.0]), (3, [2.0, 2.0, 2.0]), (4, [-1.0, 0.0, 1.0]), (5, [0.0, 0.0, 9.0]), (None, [3.0, -7.0, 0.0])]
    bad = [(6, None), (7, []), (8, [1.0, None, 2.0]), (9, [1.0, math.nan, 2.0]), (10, [math.inf, 1.0, 2.0]), (11, [1.0]), (12, [1.0, 2.0]), (13, [1.0, 2.0])]

    def run(rows, components=8):
        return whitening.whitened_components(spark.createDataFrame([(*r, 1, "x") for r in rows], kind), components=components).collect()

    compare(run(good + bad), good)
    compare(run(good + good[:1] * 3 + bad, 2), good + good[:1] * 3, 2)
    same = run([(1, [1.0, 2.0]), (1, [1.0, 2.0])])
    assert [(r["vec_id"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(1, 0, None, None, 0.0)] * 4
    line = run([(i, [float(i), 2.0 * i, 7.0]) for i in range(9)])
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line) and abs(line[0]["explained"] - 1) < 1e-12
    huge = run([(1, [1e300, 1.0]), (2, [-1e300, 1.0])])
    assert {r["deviation"] for r in huge} == {None} and len(huge) == 4
    assert run([]) == [] and run(bad[:5]) == []


def test_exact_squares():
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 49), 1 << 49, (50, 9)) >> rng.integers(0, 45, (50, 9))
    want = [sum(int(v) ** 2 for v in row) for row in x]
    assert whitening.squared_lengths(x) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("kind", ["random", "clustered", "multiple", "low rank", "zero"])
def test_eigenpairs_of_matrices(kind):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    values = {
        "random": rng.exponential(size=90),
        "clustered": 5 + np.arange(90) * 1e-4,
        "multiple": np.repeat(np.arange(30.0), 3),
        "low rank": np.where(np.arange(90) < 4, 3.0, 0.0),
        "zero": np.zeros(90),
    }[kind]
    a = (q * values) @ q.T
    found, vectors = largest_eigenpairs(lambda y: a @ y, 90, 8)
    assert np.allclose(found, np.sort(values)[::-1][:8], atol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-12 * max(1.0, values.max())


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    a, shifts = (q * np.arange(1.0, 13.0)) @ q.T, np.array([3.3, 7.6])
    rhs = rng.standard_normal((12, 2))
    x = minres(lambda y: a @ y, shifts, lambda y: y, rhs, steps=12)
    assert np.linalg.norm(a @ x - x * shifts - rhs, axis=0).max() <= 0.06 * np.linalg.norm(rhs, axis=0).max()
