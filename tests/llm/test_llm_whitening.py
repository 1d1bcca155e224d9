"""Whitening and its eigenpairs against a dense solver and exact integers."""

from __future__ import annotations

import math
import pathlib

import numpy as np
import pytest

from martloom.llm import feast, registry, whitening

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, component int, n string, vector int, value int"


def fixed(vector):
    return [math.floor(1024 * float(c)) + 100_000 for c in vector]


def whitened(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "a", 2, 3) for r in rows], SCHEMA)
    return whitening.whitened(table, **options).collect()


def check(found, rows, components=8):
    """`rows` (vec_id, vector) against numpy; ids are distinct."""
    x = np.array([fixed(np.float32(v)) for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    covariance = np.cov(x.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    scores = (x - x.mean(axis=0)) @ (vectors / np.sqrt(values))
    at = {vec_id: i for i, (vec_id, _) in enumerate(rows)}
    got = np.full((n, components), np.nan)
    for row in found:
        i, k = at[row["vec_id"]], row["component"] - 1
        got[i, k] = row["whitened"]
        exact = sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[i], sums, strict=True))
        assert (row["n"], row["deviation"]) == (n, exact)
        assert row["explained"] == pytest.approx(values[k] / np.trace(covariance), rel=1e-9)
        assert row["identity_error"] < 1e-9
    assert len(found) == n * components
    signs = np.sign((got * scores).sum(axis=0))
    assert np.abs(got * signs - scores).max() < 1e-8


def spread(count, size, seed=3):
    draw = np.random.default_rng(seed)
    data = draw.standard_normal((count, size)) * np.linspace(1, 0.1, size)
    return [(i, [float(c) for c in row]) for i, row in enumerate(data.astype(np.float32))]


@pytest.mark.parametrize("count,size,components", [(400, 24, 8), (60, 5, 5), (300, 70, 8)])
def test_against_a_dense_solver(spark, count, size, components):
    rows = spread(count, size)
    check(whitened(spark, rows), rows, components)


def test_unusable_rows_are_left_out(spark):
    rows = spread(200, 10)
    nan, inf = float("nan"), float("inf")
    others = [(900, None), (901, []), (902, [None] * 10), (903, [1.0] * 9 + [nan]), (904, [inf] + [0.0] * 9)]
    others += [(905, [-inf] * 10), (906, [0.5] * 3)]
    check(whitened(spark, rows + others), rows)


def test_repeated_rows_null_ids_and_no_variance(spark):
    rows = spread(50, 4)
    found = whitened(spark, [(None, v) for _, v in rows] * 2)
    assert len(found) == 50 * 2 * 4
    assert all(r["vec_id"] is None and r["n"] == 100 for r in found)
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, [1.0, 2.0])]) == []
    assert whitened(spark, [(1, [1.0, 2.0])] * 5) == []
    # one direction has variance: one component
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(6)]
    assert {r["component"] for r in whitened(spark, line)} == {1}


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i * 2**40), float(i % 3)]) for i in range(4)]
    x = np.array([fixed(v) for _, v in rows], object)
    with pytest.raises(Exception, match="long|large|int"):
        whitened(spark, [(i, [v[0] * 4096, v[1]]) for i, v in rows])
    products = whitening._exact_products(x.astype(np.int64) - 100_000)
    y = x - 100_000
    assert products == [int((y[:, i] * y[:, j]).sum()) for i, j in ((0, 0), (0, 1), (1, 1))]


def test_inertia_counts():
    draw = np.random.default_rng(5)
    for size in (1, 2, 7, 40):
        a = draw.standard_normal((size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (*draw.standard_normal(6) * 3, 0.0):
            assert feast.positive_pivots(a, float(shift)) == int((values > shift).sum())
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert feast.positive_pivots(swap, 0.0) == 1


def test_close_and_equal_eigenvalues(spark):
    draw = np.random.default_rng(6)
    turn, _ = np.linalg.qr(draw.standard_normal((30, 30)))
    for values in ([5.0] * 6 + [4.0] * 24, [9.0, 9.0 - 1e-9, 8.0] + [1.0] * 27, list(np.linspace(2, 1.9, 30))):
        matrix = turn @ np.diag(values) @ turn.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = feast.leading_pairs(spark, matrix, 8)
        assert np.allclose(found, sorted(values, reverse=True)[:8], rtol=1e-12)
        assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-9
        assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11


@pytest.mark.skipif(not pathlib.Path(FOLDER).is_dir(), reason="no test tables")
def test_registered_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = registry.QUERIES["op13_feast_whitening"](spark, FOLDER).collect()
    check(found, [tuple(r) for r in rows])
