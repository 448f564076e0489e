"""Response counts per item, subgroup, domain and testlet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from respan.functions.columns import is_blank_level
from respan.functions.qid import item_lookup

DEMOGRAPHICS = ("college", "wave", "gender", "ethnicity", "military", "pell")


def item_counts(resp: DataFrame) -> DataFrame:
    """Responded, wrong, correct and the two proportions per item, in one pass."""
    y = F.col("response")
    return resp.groupBy("QID").agg(
        F.count(y).alias("n_responded"),
        F.count_if(y == 0).alias("n_wrong"),
        F.count_if(y == 1).alias("n_correct"),
        F.avg((y == 1).cast("double")).alias("prop_correct"),
        F.avg((y == 0).cast("double")).alias("prop_wrong"),
    )


def item_sample_size(
    resp: DataFrame, covars: DataFrame, demographics: Sequence[str] = DEMOGRAPHICS
) -> DataFrame:
    """Responses per (item, demographic, level).

    The join keeps one row per response; it is counted per combination of levels before the
    demographics are unpivoted, so only that small table is widened.
    """
    who = covars.select("global_id", *demographics)
    combos = (
        resp.filter(F.col("response").isNotNull())
        .select("global_id", "QID")
        .join(who, "global_id")
        .groupBy("QID", *demographics)
        .agg(F.count("*").alias("_n"))
    )
    long = combos.unpivot(["QID", "_n"], list(demographics), "demographic", "group_value")
    return long.groupBy("QID", "demographic", "group_value").agg(F.sum("_n").alias("n_responded"))


def overall_n(counts: DataFrame) -> DataFrame:
    per_demo = counts.groupBy("QID", "demographic").agg(F.sum("n_responded").alias("_n"))
    return per_demo.groupBy("QID").agg(F.max("_n").alias("overall_n"))


def min_group_n(
    counts: DataFrame, demographics: Sequence[str] | None = None, name: str = "min_group_n"
) -> DataFrame:
    """Smallest non-blank level, over the named demographics or over all."""
    rows = counts.filter(~is_blank_level(F.col("group_value")))
    if demographics is not None:
        rows = rows.filter(F.col("demographic").isin(list(demographics)))
    return rows.groupBy("QID").agg(F.min("n_responded").alias(name))


def count_distribution(counts: DataFrame, by: str | None = None, labels: str = "b") -> DataFrame:
    """Spread of ``n_responded`` over the items of each domain or testlet (or of all items).

    ``counts`` has one row per item, so ``percentile`` holds at most the item bank.
    """
    rows = counts.select("QID", "n_responded")
    n = F.col("n_responded")

    def q(p):
        return F.percentile(n, F.lit(p))

    if by is None:
        return rows.agg(
            F.min(n).alias("min"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"),
            F.max(n).alias("max"), F.avg(n).alias("mean"), F.stddev_samp(n).alias("sd"),
        )
    rows = rows.join(item_lookup(rows, labels), "QID", "left")
    return rows.groupBy(by).agg(
        F.count("*").alias("n_items"), F.min(n).alias("min_n"), q(0.25).alias("q1_n"),
        q(0.5).alias("median_n"), q(0.75).alias("q3_n"), F.max(n).alias("max_n"),
    )


def item_count_summaries(
    resp: DataFrame, covars: DataFrame, demographics: Sequence[str] = DEMOGRAPHICS
) -> DataFrame:
    """Spread of item sizes overall, by domain, by testlet and by subgroup, as one table."""
    counts = item_counts(resp).select("QID", "n_responded")
    n = F.col("n_responded")
    lookup = item_lookup(counts)
    base = counts.join(lookup, "QID", "left")
    tagged = base.select(
        "QID",
        "n_responded",
        F.explode(
            F.array(
                F.struct(F.lit("overall").alias("scope"), F.lit("all").alias("level")),
                F.struct(F.lit("domain").alias("scope"), F.col("domain").alias("level")),
                F.struct(F.lit("testlet").alias("scope"), F.col("testlet").alias("level")),
            )
        ).alias("t"),
    ).select("QID", "n_responded", "t.scope", "t.level")
    groups = item_sample_size(resp, covars, demographics).select(
        "QID", "n_responded", F.col("demographic").alias("scope"), F.col("group_value").alias("level")
    )
    return (
        tagged.unionByName(groups)
        .groupBy("scope", "level")
        .agg(
            F.count("*").alias("n_items"),
            F.min(n).alias("min_n"),
            F.percentile(n, F.lit(0.5)).alias("median_n"),
            F.max(n).alias("max_n"),
        )
    )
