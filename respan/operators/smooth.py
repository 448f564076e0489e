"""Smooth trend of y over x: a penalised cubic spline whose normal equations are sums over the rows.

x is brought to 0..1.  The columns are 1, x, x^2, x^3 and (x - k)^3 where positive, for equally spaced knots k; only the latter
are penalised.  All cross products are summed in one aggregate, so the rows are read once after their range is known, and what
is solved has as many rows as columns, whatever the data.  The penalty is chosen by generalised cross-validation.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

KNOTS = 8
PENALTIES = tuple(10.0**k for k in range(-8, 5))
_DDL = "x double, fitted double, se double"


class Spline(NamedTuple):
    low: float
    high: float
    coef: np.ndarray
    cov: np.ndarray  # of the coefficients
    penalty: float
    edf: float  # effective degrees of freedom
    n: int


def _terms(u: Column, knots: int) -> list[Column]:
    cubes = [F.pow(F.greatest(u - (j + 1) / (knots + 1), F.lit(0.0)), 3) for j in range(knots)]
    return [F.lit(1.0), u, u * u, u * u * u, *cubes]


def _design(u: np.ndarray, knots: int) -> np.ndarray:
    places = (np.arange(knots) + 1) / (knots + 1)
    return np.column_stack([np.ones_like(u), u, u**2, u**3, np.maximum(u[:, None] - places, 0) ** 3])


def _known(df: DataFrame, x: str, y: str) -> DataFrame:
    value = lambda c: F.col(f"`{c}`").cast("double")
    rows = df.select(value(x).alias("x"), value(y).alias("y"))
    return rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))


def cross_products(df: DataFrame, x: str, y: str, low: float, high: float, knots: int = KNOTS) -> DataFrame:
    """(i, j, value) for i <= j: sums of products of the columns; y is the last column.  One aggregate, one row a cell."""
    width = (high - low) or 1.0
    columns = [*_terms((F.col("x") - low) / width, knots), F.col("y")]
    k = len(columns)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    sums = _known(df, x, y).agg(*[F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}") for i, j in cells])
    packed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}_{j}").alias("value")) for i, j in cells])
    return sums.select(F.explode(packed).alias("c")).select("c.*")


def fit_spline(df: DataFrame, x: str, y: str, knots: int = KNOTS, penalties: tuple[float, ...] = PENALTIES) -> Spline | None:
    """The spline of least generalised cross-validation; None without a row that has both values.

    Rows with a null or NaN in either are left out.  If x has one value alone the curve is its mean.  Runs two jobs.
    """
    ends = _known(df, x, y).agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    if ends.low is None:
        return None
    k = knots + 4
    full = np.zeros((k + 1, k + 1))
    for r in cross_products(df, x, y, ends.low, ends.high, knots).collect():  # (k + 2) choose 2 rows
        full[r.i, r.j] = full[r.j, r.i] = r.value
    xx, xy, yy = full[:k, :k], full[:k, k], full[k, k]
    n = int(round(xx[0, 0]))
    shrink = np.diag([0.0] * 4 + [1.0] * knots)
    tiny = np.eye(k) * 1e-13 * np.trace(xx) / k  # where x has few values, several curves fit alike
    best = None
    for penalty in penalties:
        inverse = np.linalg.inv(xx + penalty * n * shrink + tiny)
        coef = inverse @ xy
        edf = float(np.trace(inverse @ xx))
        rss = max(float(yy - 2 * coef @ xy + coef @ xx @ coef), 0.0)
        if edf >= n:
            continue
        score = n * rss / (n - edf) ** 2
        if best is None or score < best[0]:
            best = (score, Spline(ends.low, ends.high, coef, inverse @ xx @ inverse * rss / (n - edf), penalty, edf, n))
    if best is None:
        inverse = np.linalg.inv(xx + penalties[-1] * n * shrink + tiny)
        return Spline(ends.low, ends.high, inverse @ xy, np.zeros((k, k)), penalties[-1], float(np.trace(inverse @ xx)), n)
    return best[1]


def smooth_trend(df: DataFrame, x: str, y: str, points: int = 50, knots: int = KNOTS) -> DataFrame:
    """``x, fitted, se``: the curve at equally spaced points over the range of x, with its standard error; no rows for no data."""
    spline = fit_spline(df, x, y, knots)
    spark = df.sparkSession
    if spline is None:
        return spark.createDataFrame([], _DDL)
    u = np.linspace(0, 1, points if spline.high > spline.low else 1)
    at = _design(u, knots)
    se = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", at, spline.cov, at), 0))
    rows = zip((spline.low + u * (spline.high - spline.low)).tolist(), (at @ spline.coef).tolist(), se.tolist())
    return spark.createDataFrame(list(rows), _DDL)
