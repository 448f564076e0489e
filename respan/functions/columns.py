"""Column builders for casts, flags, differences and text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

BLANK_LEVELS = ("NA", "")


def to_double(col: Column) -> Column:
    """Lenient numeric cast: text that is not a number becomes null, NaN too."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def clean_text(col: Column, lower: bool = True) -> Column:
    """Trim, optionally lower-case, blank to null."""
    text = F.trim(col.cast("string"))
    return F.nullif(F.lower(text) if lower else text, F.lit(""))


def paste_cols(*cols: Column) -> Column:
    """Concatenate; a null prints as ``NA``."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def is_blank_level(col: Column) -> Column:
    return col.isNull() | col.isin(*BLANK_LEVELS)


def pair_difference(a: Column, b: Column) -> dict[str, Column]:
    return {"diff": a - b, "absdiff": F.abs(a - b), "avg": (a + b) / 2}


def range_flag(col: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """True below ``lo`` or above ``hi``; null never raises the flag."""
    tests = []
    if lo is not None:
        tests.append(col < lo)
    if hi is not None:
        tests.append(col > hi)
    return F.coalesce(reduce(lambda x, y: x | y, tests), F.lit(False))


def count_flags(*flags: Column) -> Column:
    return reduce(lambda x, y: x + y, [F.coalesce(f.cast("int"), F.lit(0)) for f in flags])


def null_last(col: str, direction: str = "asc") -> Column:
    return F.col(col).desc_nulls_last() if direction == "desc" else F.col(col).asc_nulls_last()
