"""Registry of queries: one per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.views import Fixtures, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(fx) -> DataFrame`` under its name; doubles are rounded to 6 decimals."""

    def add(fn: Callable[[Fixtures], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is already registered")
        QUERIES[key] = lambda spark, sf_dir: rounded(fn(Fixtures(spark, sf_dir)))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    # adding zero turns a rounded -0.0 into 0.0
    return df.select(
        [(F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    )
