"""The smoother against a dense solve over all rows."""

import numpy as np
import pytest

from respan.operators import smooth


def dense(x, y, knots, penalty):
    u = (x - x.min()) / ((x.max() - x.min()) or 1.0)
    a = np.column_stack([np.ones_like(u), u, u**2, u**3, *[np.maximum(u - (j + 1) / (knots + 1), 0) ** 3 for j in range(knots)]])
    root = np.sqrt(penalty * len(x)) * np.eye(a.shape[1])[4:]
    return np.linalg.lstsq(np.vstack([a, root]), np.concatenate([y, np.zeros(knots)]), rcond=None)[0], a


def test_curve_equals_a_dense_solve(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-5, 20, 3000)
    y = np.sin(x / 3) + rng.normal(0, 0.2, 3000)
    rows = list(zip(x.tolist(), y.tolist())) + [(None, 1.0), (2.0, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(6)
    spline = smooth.fit_spline(df, "x", "y")
    coef, a = dense(x, y, smooth.KNOTS, spline.penalty)
    assert spline.n == 3000 and 5 < spline.edf < 12
    fitted = a @ coef
    u = (x - spline.low) / (spline.high - spline.low)
    np.testing.assert_allclose(smooth._design(u, smooth.KNOTS) @ spline.coef, fitted, atol=1e-5)
    curve = smooth.smooth_trend(df, "x", "y", 40).toPandas()
    assert np.abs(curve["fitted"] - np.sin(curve["x"] / 3)).max() < 0.15 and (curve["se"] > 0).all()
    # the chosen penalty is the best of those offered
    scores = {}
    for p in smooth.PENALTIES:
        c, a = dense(x, y, smooth.KNOTS, p)
        edf = np.trace(np.linalg.solve(a.T @ a + p * len(x) * np.diag([0.0] * 4 + [1.0] * smooth.KNOTS), a.T @ a))
        scores[p] = len(x) * ((y - a @ c) ** 2).sum() / (len(x) - edf) ** 2
    assert scores[spline.penalty] == pytest.approx(min(scores.values()), rel=1e-6)


def test_little_data(spark):
    make = lambda rows: spark.createDataFrame(rows, "x double, y double")
    assert smooth.smooth_trend(make([]), "x", "y").isEmpty()
    assert smooth.smooth_trend(make([(1.0, None)]), "x", "y").isEmpty()
    one = smooth.smooth_trend(make([(2.0, 3.0), (2.0, 5.0)]), "x", "y").collect()
    assert len(one) == 1 and one[0].x == 2.0 and abs(one[0].fitted - 4.0) < 1e-6
    line = smooth.smooth_trend(make([(float(i), 2.0 * i + 1) for i in range(30)]), "x", "y", 5).collect()
    assert all(abs(r.fitted - (2 * r.x + 1)) < 1e-3 for r in line)
