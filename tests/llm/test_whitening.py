"""Whitening against exact integers, double-precision eigenvectors and plain numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import entries, whitening
from ordermill.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>"


def by_hand(rows):
    """Per row: id, exact deviation and centred x; and the exact covariance as extended floats."""
    xs = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows]
    n, size = len(xs), len(xs[0][1])
    sums = [sum(x[k] for _, x in xs) for k in range(size)]
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in xs]
    centred = [[Fraction(n * a - s, n) for a, s in zip(x, sums)] for _, x in xs]
    return n, deviation, centred


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def check(found, rows, components=8):
    n, deviation, centred = by_hand(rows)
    z = np.array([[float(c) for c in row] for row in centred])
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, len(values))
    assert len(found) == n * k
    assert sorted((r.vec_id, int(r.deviation)) for r in found if r.component == 1) == sorted(deviation)
    for c in range(k):
        own = sorted((r.vec_id, r.whitened) for r in found if r.component == c + 1)
        white = z @ vectors[:, c] / math.sqrt(values[c])
        either = [sorted(zip([i for i, _ in rows], sign * white)) for sign in (1, -1)]
        assert min(max(abs(a[1] - b[1]) for a, b in zip(own, other)) for other in either) < 1e-8
    assert {r.n for r in found} == {n}
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_exact_products_of_any_size():
    draw = np.random.default_rng(1)
    for top in (1, 1 << 10, 1 << 25, 1 << 43):
        a, b = draw.integers(-top, top + 1, (300, 4)), draw.integers(-5, 6, (300, 3))
        for x, y in ((a, a), (a, b), (b, a)):
            expected = np.array([[sum(int(p) * int(q) for p, q in zip(x[:, i], y[:, j])) for j in range(y.shape[1])] for i in range(x.shape[1])], object)
            assert (whitening.exact_products(x, y) == expected).all()


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    q = q + q @ (np.eye(len(values)) - q.T @ q) / 2  # orthogonal beyond double precision
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values",
    [[9, 7, 5, 4, 3, 2, 1, 0.5], [5, 5 - 1e-6, 5 - 2e-6, 3, 3 - 1e-9, 1, 1e-3, 1e-9], [1e6, 1e6 - 1e-5, 7, 7 - 1e-7, 7 - 2e-7, 1, 0.5, 0.1]],
)
def test_clustered_eigenvalues_are_told_apart(values):
    matrix, q = spectrum(values)
    found, vectors = whitening.eigen(matrix)
    assert np.abs(found - np.array(values, np.longdouble)).max() < 1e-16 * max(values)
    eps, gap = np.finfo(np.longdouble).eps, min(abs(a - b) for i, a in enumerate(values) for b in values[:i])
    wrong = np.minimum(np.abs(vectors - q).max(axis=0), np.abs(vectors + q).max(axis=0)).max()
    assert wrong < 100 * eps * max(values) / gap  # what the matrix's own rounding leaves open
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 100 * eps
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-16 * max(values)


def test_equal_eigenvalues_and_zero_matrices():
    matrix, _ = spectrum([4, 4, 4, 1, 0, 0, 0, 0])
    values, vectors = whitening.eigen(matrix)
    assert np.abs(values - [4, 4, 4, 1, 0, 0, 0, 0]).max() < 1e-15
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-15
    assert whitening.eigen(np.zeros((3, 3), np.longdouble))[0].tolist() == [0, 0, 0]


def test_float64_is_left_behind():
    matrix, q = spectrum([1 + k / 50 for k in range(64, 0, -1)])
    found = whitening.eigen(matrix)[1]
    wrong = np.minimum(np.abs(found - q).max(axis=0), np.abs(found + q).max(axis=0)).max()
    assert wrong < 1e-16


def test_whiten_edge_rows(spark):
    draw = np.random.default_rng(2)
    good = [(i, (draw.normal(size=6) * [5, 4, 3, 2, 1, 0.5] + 3).tolist()) for i in range(200)]
    good += [(7, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])] * 2 + [(500, [0.0] * 6)]
    bad = [(900, None), (901, []), (902, [1.0, None] * 3), (903, [math.nan] * 6), (904, [math.inf] + [1.0] * 5), (905, [1.0, 2.0]), (906, [1e300] * 6)]
    docs = spark.createDataFrame(good + bad, SCHEMA).withColumns({n: F.lit("x") for n in ("n", "vec", "whitened", "component", "size", "k")})
    check(whitening.whiten(docs.repartition(5)).collect(), good)


def test_large_entries_stay_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=3) * 1e6).tolist()) for i in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, int(r.deviation)) for r in found if r.component == 1) == sorted(by_hand(rows)[1])


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(None, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    rows = whitening.whiten(same).collect()
    assert len(rows) == 4 and all(r.whitened is None and r.identity_error is None and r.explained == 0 and r.deviation == 0 for r in rows)
    line = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], SCHEMA)
    rows = whitening.whiten(line).collect()
    assert sorted(abs(r.whitened) for r in rows if r.component == 1) == [1, 1]
    assert all(r.whitened is None for r in rows if r.component == 2)
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []


def test_op11_on_a_whole_table(spark):
    rows = usable([(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()])
    check(entries.op11_whitening(spark, SF).collect(), rows)
