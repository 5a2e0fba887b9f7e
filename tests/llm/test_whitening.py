"""Operator 12 against exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tapeloom.llm import queries, whitening


def brute(vectors):
    """Grid points, covariance in exact arithmetic, its eigenvalues and vectors."""
    x = [[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dims)]
    cov = [[float(Fraction(n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j], n * n)) for j in range(dims)] for i in range(dims)]
    values, vecs = np.linalg.eigh(np.array(cov))
    return x, n, sums, np.array(cov), values[::-1], vecs[:, ::-1]


def compare(rows, got, most=32):
    x, n, sums, cov, values, vecs = brute([v for _, v in rows])
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(r, sums)] for r in x])
    want = centred @ vecs[:, :most] / np.sqrt(values[:most])
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    k = want.shape[1]
    assert all(sorted(c) == list(range(1, k + 1)) for c in by.values()) and len(got) == k * len(rows)
    found = np.array([[by[i][c + 1].whitened for c in range(k)] for i, _ in rows])
    assert np.abs(found * np.sign((found * want).sum(0)) - want).max() < 1e-7
    for (i, _), r in zip(rows, x):
        assert by[i][1].deviation == sum((n * v - s) ** 2 for v, s in zip(r, sums))
    for r in got:
        assert r.n == n and r.identity_error < 1e-9 and r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    assert np.abs(found.T @ found / n - np.eye(k)).max() < 1e-9


def test_query(spark, small_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    compare(rows, queries.op12_embedding_whitening(spark, small_dir).collect())


def test_far_from_the_origin_and_few_dimensions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(60, 3)) * [1, 5, 0.05] + [4e9, -7e8, 1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(rows, whitening.whitening_report(df).collect())


def test_blocks_of_the_triangle(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(80, 11)) @ rng.normal(size=(11, 11)))]
    grid = whitening.on_grid(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    whole, cut = whitening.fit(grid, 11), whitening.fit(grid, 11, block=4)
    assert np.array_equal(whole.values, cut.values) and np.array_equal(whole.vectors, cut.vectors) and whole.sums == cut.sums


ODD = [(None, None), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, []), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [3.0, 1.0]), (6, [1e30, 1.0]), (7, [4.0, 4.0, 4.0])]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, 2.0) for r in ODD], "vec_id long, embedding array<double>, n int, deviation double")
    got = sorted((r.vec_id is None, r.component, r.n, r.deviation, round(abs(r.whitened), 9), r.explained) for r in whitening.whitening_report(df).collect())
    assert got == [(False, 1, 3, 20480, 0.707106781, 1.0)] * 2 + [(True, 1, 3, 81920, 1.414213562, 1.0)]
    for rows in (df.limit(0), df.where("vec_id = 5"), df.where("vec_id = 7"), df.where("vec_id < 5")):
        assert whitening.whitening_report(rows).count() == 0


def test_deviation_past_a_long(spark):
    df = spark.createDataFrame([(1, [1e15, 1.0]), (2, [-1e15, 2.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whitening_report(df).collect()} == {None}
