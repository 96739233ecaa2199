"""Whitening against the eigenvectors of the whole covariance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdgrid.llm import whitening
from crowdgrid.llm.common import table
from crowdgrid.llm.queries import QUERIES

VECTORS = "vec_id long, x array<long>"


class Formed:
    """A covariance that is there as a matrix, and counts its products."""

    def __init__(self, matrix):
        self.matrix, self.passes = matrix, 0

    def __matmul__(self, q):
        self.passes += 1
        return self.matrix @ q


def spectrum(values, seed=0):
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    return turn * np.array(values) @ turn.T


def check(matrix, components=8, tolerance=1e-9):
    formed = Formed(matrix)
    values, vectors, residuals = whitening.leading(formed, len(matrix), components)
    want, exact = np.linalg.eigh(matrix)
    want, exact = want[::-1][:components], exact[:, ::-1][:, :components]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-13 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * want[0]
    if tolerance:
        assert np.abs(np.abs((vectors * exact).sum(axis=0)) - 1).max() < tolerance
    return formed.passes


@pytest.mark.parametrize("width", [1, 3, 8, 9, 33, 64, 200, 700])
def test_vectors_of_noise(width):
    x = np.random.default_rng(width).standard_normal((4 * width + 5, width))
    check(np.cov(x.T).reshape(width, width))


def test_a_clear_gap_takes_few_products():
    assert check(spectrum([100, 90, 80, 70, 60, 50, 40, 30] + [1] * 400)) <= 20


def test_spectra_without_a_gap():
    check(spectrum(np.linspace(2, 1, 300)))
    check(spectrum([1.0] * 80), tolerance=None)
    check(spectrum([5.0] * 12 + [1.0] * 90), tolerance=None)
    check(spectrum([3.0, 2.0] + [0.0] * 70), components=2)


def test_spread_over_many_digits():
    values = whitening.leading(Formed(np.diag(10.0 ** -np.arange(60.0))), 60)[0]
    assert np.allclose(values, 10.0 ** -np.arange(8.0), rtol=1e-7)


def wide(found):
    rows = found.orderBy("vec_id", "component").collect()
    return rows, np.array([r.whitened for r in rows], dtype=float)


def test_embeddings_of_the_tables(spark, sf_dir):
    rows, got = wide(QUERIES["op12_whitening"](spark, sf_dir))
    source = table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    x = np.floor(np.array([r.embedding for r in source]) * 1024).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    away = x - sums / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    want = away @ vectors / np.sqrt(values)
    got = got.reshape(n, 8)
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-9
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    assert [r.deviation for r in rows[::8]] == exact
    assert [r.component for r in rows[:8]] == list(range(1, 9)) and {r.n for r in rows} == {n}
    trace = (away**2).sum() / n
    assert np.allclose([r.explained for r in rows[:8]], values / trace, rtol=1e-10)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-10


def test_odd_vectors_and_repeated_rows(spark):
    r = np.random.default_rng(1)
    good = [(i % 50 or None, [int(v) for v in r.integers(-90, 90, 3)]) for i in range(60)]
    bad = [(901, None), (902, []), (903, [1, None, 2]), (904, [1, 2]), (905, [1, 2, 1 << 41])]
    frame = spark.createDataFrame(good + good[:5] + bad, VECTORS).withColumn("n", F.lit("x")).repartition(3)
    found = whitening.whiten(frame.withColumn("component", F.lit(1)))
    assert found.count() == 65 * 3
    assert found.filter("vec_id > 900").count() == 0
    assert found.filter("vec_id is null").count() == 3 * sum(i is None for i, _ in good + good[:5])
    x = np.array([v for _, v in good + good[:5]])
    away = x - x.mean(axis=0)
    lengths = sorted((away @ np.linalg.inv(away.T @ away / 65) * away).sum(axis=1))
    rows = found.groupBy("vec_id", "deviation").agg(F.sum(F.pow("whitened", F.lit(2))).alias("s"), F.count("*").alias("c"))
    got = sorted(s.s / (s.c / 3) for s in rows.collect() for _ in range(s.c // 3))
    assert np.allclose(got, lengths)


def test_vectors_without_variance(spark):
    same = whitening.whiten(spark.createDataFrame([(i, [5, 6]) for i in range(4)], VECTORS)).collect()
    assert len(same) == 8
    assert all(r.whitened is None and r.explained == 0 and r.deviation == 0 for r in same)
    assert all(r.identity_error is None for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [i, 2 * i, 7]) for i in range(9)], VECTORS)).collect()
    assert sum(r.whitened is None for r in line) == 18
    assert {r.whitened is None for r in line if r.component > 1} == {True}
    assert line[0].explained == pytest.approx(1)


def test_no_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], VECTORS)).collect() == []


def test_entries_become_whole_numbers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([0.5, -0.0001],), ([nan, 1.0],), ([inf, 1.0],), ([None, 1.0],), (None,), ([],), ([1e30, 1.0],)]
    frame = spark.createDataFrame(rows, "e array<float>")
    got = [r.x for r in frame.select(whitening.whole_entries(F.col("e")).alias("x")).collect()]
    assert got == [[100512, 99999], None, None, None, None, [], None]


def test_deviations_beyond_a_long(spark):
    rows = [(i, [(-1) ** i << 39, i]) for i in range(64)]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.deviation for r in found} == {None}
    assert max(r.identity_error for r in found) < 1e-4
