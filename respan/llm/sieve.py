"""Leaving out, before a shuffle, most rows that a join would drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 1 << 18  # of 64 bits each: the most rows that are broadcast


def _place(on: list[str]) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(64 * WORDS))


def sift(rows: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``on`` columns have no equal in ``wanted``; all that have one stay.

    A bit is set for the hash of each wanted key, so the table that is broadcast has a bound, and an inner join still has
    to follow (Spark would move a semi join below this one, to where all rows are).  ``wanted`` is computed once more
    here and should be a table that was written; its columns ``on`` have the types of those of ``rows``.
    """
    bit = F.expr("shiftleft(1L, cast(__p & 63 as int))")
    placed = wanted.select(_place(on).alias("__p")).select(F.shiftright("__p", 6).alias("__w"), bit.alias("__b"))
    bits = placed.groupBy("__w").agg(F.bit_or("__b").alias("__bits"))
    met = rows.withColumn("__p", _place(on)).withColumn("__w", F.shiftright("__p", 6)).join(F.broadcast(bits), "__w")
    return met.where(F.col("__bits").bitwiseAND(bit) != 0).select(*[F.col(f"`{c}`") for c in rows.columns])
