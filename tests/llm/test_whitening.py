import math
from fractions import Fraction

import numpy as np
import pytest

from geokernel.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact_polynomial(matrix):
    """Faddeev and LeVerrier, constant term first."""
    d = len(matrix)
    total, c, one = np.zeros((d, d), object), [0] * d + [1], np.eye(d, dtype=int).astype(object)
    for k in range(1, d + 1):
        total = matrix @ total + c[d - k + 1] * one
        c[d - k] = -int(np.trace(matrix @ total)) // k
    return c


def scatter_of(rows):
    a = np.array(rows).astype(object)
    return a.T @ a


def test_polynomial_equals_exact_one(spark):
    rng = np.random.default_rng(3)
    for d, rows in ((1, 4), (2, 1), (5, 3), (9, 40)):
        matrix = scatter_of(rng.integers(-(10**6), 10**6, (rows, d)))
        assert wh.characteristic_polynomial(spark, matrix) == exact_polynomial(matrix)
    zero_pivots = np.array([[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]], object)
    assert wh.characteristic_polynomial(spark, zero_pivots) == exact_polynomial(zero_pivots)


def test_roots_with_multiplicities():
    polynomial = [1]
    for root in (3, 3, 3, 8, 20):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0], strict=True)]
    assert [wh.roots_above(polynomial, x) for x in (0, 2, 3, 8, 19, 20)] == [5, 5, 2, 1, 1, 0]
    found = wh.isolate(polynomial, 37, 5)
    assert [m for _, _, m in found] == [1, 1, 3]
    assert [wh.narrow(polynomial, a, b) if m == 1 else b for a, b, m in found] == [20, 8, 3]


def test_components_of_equal_variance_are_orthonormal(spark):
    rng = np.random.default_rng(4)
    basis = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    for values in ((5, 5, 5, 2, 2, 1), (7, 7, 0, 0, 0, 0)):
        matrix = np.diag(values).astype(object)
        vectors, roots = wh.principal_components(spark, matrix, 6)
        kept = [v for v in values if v]
        assert [round(float(r), 12) for r in roots] == kept
        assert np.abs(vectors @ vectors.T - np.eye(len(kept))).max() < 1e-15
        assert np.abs(vectors @ matrix.astype(float) - np.array(kept)[:, None] * vectors).max() < 1e-14
    whole = np.rint(basis @ np.diag([9e8, 4e8, 4e8 - 3, 100, 1, 1]) @ basis.T).astype(np.int64)
    whole = (whole + whole.T).astype(object) + 1000 * np.eye(6, dtype=int).astype(object)
    vectors, roots = wh.principal_components(spark, whole, 3)
    assert np.allclose([float(r) for r in roots], np.linalg.eigvalsh(whole.astype(float))[::-1][:3], rtol=1e-12)
    assert np.abs(vectors @ whole.astype(float) - np.array([[float(r)] for r in roots]) * vectors).max() < 1e-6
    assert np.abs(vectors @ vectors.T - np.eye(3)).max() < 1e-15


def brute(rows, components=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in rows], object)
    n, total = len(x), x.sum(axis=0)
    deviation = ((n * x - total) ** 2).sum(axis=1)
    centred = ((n * x - total) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_equals_dense_eigenvectors_up_to_sign(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in np.float32(rng.normal(size=5) * [3, 2, 1, 0.5, 9])], i % 3) for i in range(200)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = wh.whiten(table, wh.fit_whitening(table)).orderBy("vec_id", "component").collect()
    deviation, whitened, explained = brute(rows)
    assert len(found) == 1000 and {r["n"] for r in found} == {200}
    assert [int(r["deviation"]) for r in found[::5]] == deviation.tolist()
    got = np.array([r["whitened"] for r in found]).reshape(200, 5)
    assert np.abs(np.abs(got) - np.abs(whitened)).max() < 1e-9
    assert np.allclose([r["explained"] for r in found[:5]], explained, rtol=1e-10)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-12
    assert np.abs(got.T @ got / 200 - np.eye(5)).max() < 1e-12


def test_unsound_vectors_repeats_and_names(spark):
    sound = [(1, [0.5, 1.0], 1), (1, [0.5, 1.0], 1), (None, [2.0, -3.0], None), (4, [1e30, 0.25], 2)]
    bad = [(5, None, 1), (6, [], 1), (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [float("inf"), 1.0], 1)]
    table = spark.createDataFrame(sound + bad, SCHEMA).selectExpr("*", "1 AS component", "'x' AS whitened", "2 AS id")
    models = wh.fit_whitening(table)
    found = wh.whiten(table, models).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    assert {r["n"] for r in found} == {4} and found[0]["identity_error"] < 1e-6
    assert Fraction(sum(models[2].explained)).limit_denominator(10**6) == 1


def test_lengths_have_fits_of_their_own_and_flat_tables_none(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=2 + i % 2).tolist(), 1) for i in range(40)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = wh.whiten(table, wh.fit_whitening(table)).groupBy("n").count().collect()
    assert [(r["n"], r["count"]) for r in found] == [(20, 100)]
    for flat in ([], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]):
        table = spark.createDataFrame(flat, SCHEMA)
        assert wh.whiten(table, wh.fit_whitening(table)).count() == 0


@pytest.mark.parametrize("size", [3.0, 1e9, 1e18])
def test_sums_stay_exact(spark, size):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=3) * size).tolist(), 1) for i in range(50)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = wh.whiten(table, wh.fit_whitening(table)).filter("component = 1").orderBy("vec_id").collect()
    clipped = lambda c: min(max(math.floor(64 * float(np.float32(c))), -(2**62)), 2**62)
    x = np.array([[clipped(c) for c in v] for _, v, _ in rows], object)
    want = ((50 * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert [None if r["deviation"] is None else int(r["deviation"]) for r in found] == [v if v < 10**38 else None for v in want]
