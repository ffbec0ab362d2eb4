"""Whitening against dense linear algebra, exact deviations, and odd vectors."""

import math
from collections import Counter

import numpy as np
import pytest

from texloam.llm import whitening


def plain(rows, components=16):
    """{id and vector: (n, deviation, whitened)} by a dense eigendecomposition of whole numbers."""
    usable = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in usable}), np.int64)
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums).astype(float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    out = []
    for i, v in usable:
        far = [n * a - int(s) for a, s in zip(v, sums)]
        out.append((i, n, sum(f * f for f in far), (np.array(far, float) / n) @ vectors[:, :k] / np.sqrt(values[:k])))
    return out, values[:k] / values.sum()


def compare(got, rows, components=16, tolerance=1e-8):
    expected, explained = plain(rows, components)
    assert len(got) == len(expected)
    assert Counter((r[0], r.n, r.deviation) for r in got) == Counter(e[:3] for e in expected)
    mine = {(r[0], r.deviation): np.array(r.whitened) for r in got}
    theirs = {(e[0], e[2]): e[3] for e in expected}
    a, b = (np.array([m[k] for k in sorted(theirs, key=str)]) for m in (mine, theirs))
    assert a.shape == b.shape
    signs = np.sign((a * b).sum(axis=0))
    assert np.abs(a * signs - b).max() < tolerance
    for r in got:
        assert np.allclose(r.explained, explained, rtol=1e-9) and r.identity_error < 1e-9


@pytest.mark.parametrize(("dimension", "wanted"), [(64, 16), (200, 16), (5, 16), (1, 16), (40, 3)])
def test_solver_equals_dense_eigenpairs(dimension, wanted):
    rng = np.random.default_rng(dimension)
    a = rng.standard_normal((900, dimension)) * np.linspace(3, 0.2, dimension)
    v = a.T @ a / 900
    products = []
    values, vectors = whitening.jacobi_davidson(lambda x: products.append(1) or v @ x, dimension, wanted)
    dense, exact = np.linalg.eigh(v)
    k = min(wanted, dimension)
    assert np.allclose(values, dense[::-1][:k], rtol=1e-13, atol=1e-13 * dense[-1])
    assert np.abs(np.abs((vectors * exact[:, ::-1][:, :k]).sum(axis=0)) - 1).max() < 1e-12
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 2e-14 * dense[-1]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_solver_with_equal_eigenvalues_and_none():
    v = np.diag([5.0] * 20 + [1.0] * 30)
    values, vectors = whitening.jacobi_davidson(lambda x: v @ x, 50, 16)
    assert np.allclose(values, 5) and np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
    assert not whitening.jacobi_davidson(lambda x: 0 * x, 50, 16)[0].any()


def test_minres_solves_each_column():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((12, 12))
    a, shifts = a + a.T, np.array([0.3, 2.0, -1.0])
    b = rng.standard_normal((12, 3))
    b[:, 2] = 0
    x = whitening.minres(lambda y: a @ y - shifts * y, b, 30)
    assert np.abs(a @ x - shifts * x - b).max() < 1e-7


def test_whitening_equals_dense_algebra(spark, sf):
    docs = spark.read.parquet(f"{sf}/embeddings.parquet")
    compare(whitening.whiten(docs).collect(), [(r.vec_id, r.embedding) for r in docs.collect()])


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [[float(c) for c in rng.standard_normal(5) * (4, 3, 2, 1, 0)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(good)] + [(5, good[5]), (None, good[6]), (None, None), (90, [])] + [(100 + i, good[0]) for i in range(500)]
    bad = [(70, None), (71, [1.0, None, 1.0, 1.0, 1.0]), (72, [float("nan")] * 5), (73, [math.inf, 1.0, 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in [*rows, *bad]], "vec_id long, embedding array<float>, x int, id int")
    stored = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = whitening.whiten(frame).collect()
    assert len(got[0].whitened) == 4  # the last dimension is constant
    compare(got, stored)
    compare(whitening.whiten(frame, components=2).collect(), stored, 2)
    shorter = frame.union(spark.createDataFrame([(80, [1.0], 1, 2)], frame.schema))
    assert whitening.whiten(shorter).filter("vec_id = 80").count() == 0


def test_one_vector_and_none(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert [(r.n, r.deviation, r.whitened) for r in whitening.whiten(one).collect()] == [(1, 0, [])] * 2
    assert whitening.whiten(one.filter("vec_id > 2")).count() == 0
    assert whitening.whiten(one.selectExpr("vec_id", "cast(null as array<float>) as embedding")).columns[0] == "vec_id"
    wide = spark.createDataFrame([(1, [1e8, 0.0]), (2, [-1e8, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError):
        whitening.whiten(wide)


def test_query(spark, sf):
    rows = whitening.query(spark, sf)
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    counts = {r.component: r["count"] for r in rows.groupBy("component").count().collect()}
    assert counts == {c: n for c in range(1, 17)}
