"""Whitening against a dense eigendecomposition, and the rank-one changes against the matrices they stand for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import SF
from respan.llm import eigen, queries
from respan.llm.whitening import fit_whitening, whiten


def scatter(y):
    c = y - y.mean(0)
    return c.T @ c


def made(kind, rng, n, d):
    y = np.floor(1024 * rng.normal(0, 0.1, (n, d)) * np.linspace(0.1, 2, d)).astype(np.int64)
    if kind == "few values":
        y = y[rng.integers(0, min(3, n), n)]
    if kind == "low rank":
        y[:, d - d // 2 :] = y[:, : d // 2]
    if kind == "one hot":
        y[rng.random(n) < 0.5] = y[0]
    if kind == "far":
        y += 10**9
    return y


@pytest.mark.parametrize("kind", ["plain", "few values", "low rank", "one hot", "far"])
@pytest.mark.parametrize("n, d", [(1, 3), (40, 64), (300, 16), (200, 1)])
def test_changes_follow_the_scatter(kind, n, d):
    y = made(kind, np.random.default_rng(n + d), n, d)
    parts = [eigen.empty(d) for _ in range(3)]
    for i, row in enumerate(y):
        parts[i % 3] = eigen.add(parts[i % 3], row)
    s = eigen.combine(eigen.combine(parts[0], parts[1]), parts[2])
    want = scatter(y)
    top = max(abs(want).max(), 1)
    assert (s.n, s.total.tolist()) == (n, y.sum(0).tolist())
    assert abs(s.vectors @ np.diag(s.values) @ s.vectors.T - want).max() < 1e-9 * top * (1e3 if kind == "far" else 1)
    assert abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-10
    assert (np.diff(s.values) >= 0).all()
    weighted = eigen.add(eigen.add(eigen.empty(d), y[0], 3), y[-1], 2)
    assert abs(weighted.vectors @ np.diag(weighted.values) @ weighted.vectors.T - scatter(y[[0, 0, 0, -1, -1]])).max() < 1e-9 * top * (1e3 if kind == "far" else 1)


def check(spark, vectors, rows, k=8):
    """``rows``: what the fit list should hold, as lists of doubles by id."""
    ids, c = [i for i, _ in rows], np.array([v for _, v in rows], float)
    x = np.floor(1024 * c).astype(np.int64) + 100000
    n, total = len(x), x.sum(0)
    model = fit_whitening(vectors, components=k)
    assert model.n == n and (model.total + 100000 * n == total).all()
    centred = (n * x - total) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    got = {}
    for r in whiten(vectors, model, keep=["vec_id"]).collect():
        got.setdefault(r.vec_id, []).append(r)
    assert sorted(got, key=str) == sorted(set(ids), key=str)
    assert model.trace == pytest.approx(np.trace(v), rel=1e-12)
    live = values > 1e-9 * values[0]
    assert (model.values > 0).tolist() == live.tolist()
    np.testing.assert_allclose(model.values[live], values[live], rtol=1e-9)
    assert model.identity_error < 1e-9
    want = centred @ axes[:, live] / np.sqrt(values[live])
    for i, w, dev in zip(ids, want, ((n * x.astype(object) - total.astype(object)) ** 2).sum(1)):
        assert all(r.deviation == dev for r in got[i])
        white = np.array([z for z in got[i][0].whitened if z is not None])
        np.testing.assert_allclose(np.abs(white), np.abs(w), atol=1e-7)


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(z) for z in rng.normal(0, [1, 0.3, 0.1])]) for i in range(200)] + [(7, [0.5, -0.25, 1e-9]), (None, [1.0, 2.0, 3.0])]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [float("nan"), 0.0, 0.0]), (904, [0.0, float("-inf"), 0.0]), (905, [1.0, 2.0]), (906, [1e30, 0.0, 0.0])]
    good = [g for g in good if g[0] != 7]
    vectors = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").repartition(5).withColumns({c: F.lit("x") for c in ("v", "n", "whitened", "deviation")})
    check(spark, vectors, good)
    got = whiten(vectors, fit_whitening(vectors))
    assert got.columns == ["vec_id", "embedding", "v", "n", "deviation", "whitened"] and got.count() == len(good)


def test_ranks_and_repeats(spark):
    rng = np.random.default_rng(2)
    flat = rng.normal(0, 1, (300, 2)) * [3, 1]
    rows = [(i, [float(a), float(b), float(a), 0.25]) for i, (a, b) in enumerate(np.round(flat * 64) / 64)]
    check(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40), rows)
    hot = rows[:1] * 500 + rows[1:100]  # one row five times as often as all others
    model = fit_whitening(spark.createDataFrame(hot, "vec_id long, embedding array<double>").repartition(3))
    assert model.n == 599 and model.identity_error < 1e-9


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert fit_whitening(empty) is None and whiten(empty, None).isEmpty()
    nulls = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert fit_whitening(nulls) is None
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    model = fit_whitening(one)
    assert [tuple(r) for r in whiten(one, model, keep=["vec_id"]).collect()] == [(1, 0, [None, None]), (2, 0, [None, None])]


def test_query(spark):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(spark, spark.read.parquet(f"{SF}/embeddings.parquet"), given)
    got = queries.op13_embedding_whitening(spark, SF).collect()
    assert len(got) == 8 * len(given) and {r.component for r in got} == set(range(1, 9))
    by = {r.component: r.explained for r in got}
    assert all(by[k] >= by[k + 1] > 0 for k in range(1, 8)) and sum(by.values()) <= 1
    assert {r.n for r in got} == {len(given)} and all(r.identity_error < 1e-4 for r in got)
