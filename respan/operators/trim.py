"""Item diagnostics and trimming of the bank.  All tables here have one row per item."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from respan.functions.columns import count_flags, range_flag
from respan.operators.rows import distinct_first, head_rows, sort_rows

FLAGS = ("flag_low_a", "flag_high_a", "flag_extreme_b", "flag_low_n", "flag_poor_p")


@dataclass(frozen=True)
class TrimLimits:
    low_a: float = 0.40
    high_a: float = 3.00
    extreme_b: float = 3.50
    min_n: int = 500
    low_p: float = 0.05
    high_p: float = 0.95


def item_diagnostics(
    lookup: DataFrame, counts: DataFrame, params: DataFrame, limits: TrimLimits = TrimLimits()
) -> DataFrame:
    base = lookup.join(counts, "QID", "left").join(params, "QID", "left")
    flagged = base.withColumns(
        {
            "flag_low_a": range_flag(F.col("a"), lo=limits.low_a),
            "flag_high_a": range_flag(F.col("a"), hi=limits.high_a),
            "flag_extreme_b": range_flag(F.col("b"), lo=-limits.extreme_b, hi=limits.extreme_b),
            "flag_low_n": range_flag(F.col("n_responded"), lo=limits.min_n),
            "flag_poor_p": range_flag(F.col("prop_correct"), lo=limits.low_p, hi=limits.high_p),
        }
    )
    n = count_flags(*[F.col(f) for f in FLAGS])
    return flagged.withColumns({"n_flags": n, "trim_candidate": n > 0})


WORST_FIRST = (("trim_candidate", "desc"), ("n_flags", "desc"), ("a", "asc"), ("_abs_b", "desc"), ("QID", "asc"))


def ranked_items(diag: DataFrame) -> DataFrame:
    """Worst items first: flagged, many flags, low slope, extreme location."""
    return sort_rows(diag.withColumn("_abs_b", F.abs("b")), WORST_FIRST).drop("_abs_b")


def worst_items(diag: DataFrame, k: int = 30) -> DataFrame:
    return head_rows(diag.withColumn("_abs_b", F.abs("b")), WORST_FIRST, k).drop("_abs_b")


def flag_summary(diag: DataFrame) -> DataFrame:
    """Number of items per criterion."""
    names = [*FLAGS, "any_flag"]
    totals = diag.withColumn("any_flag", F.col("trim_candidate")).agg(
        *[F.count_if(F.col(f)).alias(f) for f in names]
    )
    return totals.unpivot([], names, "criterion", "n_items")


def trim_review(diag: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """Review table: the flag decides unless a reviewer did (``QID, drop_item, reviewer_note``).

    Of several reviews of an item one counts: drop before keep, then the first note.
    """
    if reviewed is None:
        return diag.withColumns(
            {"drop_item": F.col("trim_candidate"), "reviewer_note": F.lit(None).cast("string")}
        )
    one = distinct_first(reviewed, ["QID"], [("drop_item", "desc"), ("reviewer_note", "asc")])
    r = one.select("QID", F.col("drop_item").alias("_drop"), "reviewer_note")
    return diag.join(r, "QID", "left").withColumn("drop_item", F.coalesce("_drop", "trim_candidate")).drop("_drop")


def trim_pools(review: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(retained, dropped) item ids."""
    kept = review.filter(~F.col("drop_item")).select("QID")
    dropped = review.filter(F.col("drop_item")).select("QID")
    return kept, dropped
