"""Duplicate detection, patching of survivors, completion dedupe and timing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from respan.operators.rows import Order, distinct_first


def answer_lists(resp: DataFrame, key: str, item: Column, answer: Column) -> DataFrame:
    """``key, cells``: the answered items of a respondent as (i, y) pairs in item order.

    One shuffle.  The set of pairs collapses repeats before it, so even a respondent with a
    third of all rows sends a list bounded by the item bank.  Of contradicting answers to
    an item the least stays.
    """
    pairs = F.collect_set(F.struct(item.alias("i"), answer.alias("y")))
    sets = resp.groupBy(key).agg(F.array_sort(pairs).alias("_s"))
    first = F.filter("_s", lambda c, at: (at == 0) | (F.get("_s", at - 1)["i"] != c["i"]))
    return sets.select(key, first.alias("cells"))


def score_patterns(resp: DataFrame, key: str = "global_id") -> DataFrame:
    """Digest of all answers of a respondent."""
    answered = resp.filter(F.col("response").isNotNull())
    per = answer_lists(answered, key, F.col("QID"), F.col("response"))
    text = F.transform("cells", lambda c: F.concat_ws("=", c["i"], c["y"].cast("string")))
    return per.select(
        key,
        F.size("cells").cast("long").alias("n_items"),
        F.sha2(F.array_join(text, ","), 256).alias("pattern"),
    )


def duplicate_pairs(
    df: DataFrame, keys: Sequence[str], cohort: str = "wave", key: str = "global_id"
) -> DataFrame:
    """Likely duplicates across cohorts: each row paired with the survivor of its key group.

    The survivor is the first id of the first cohort.  A group of n copies gives at most
    n - 1 pairs, never n squared; rows with a null key or a null cohort are not compared, and do
    not keep the others of their group from being compared.
    """
    known = df.dropna(subset=[cohort, *keys]).select(key, cohort, *keys)
    first = F.min(F.struct(cohort, key))
    groups = (
        known.groupBy(*keys)
        .agg(first.alias("_s"), F.max(cohort).alias("_last"))
        .filter(F.col("_s")[cohort] < F.col("_last"))
        .select(*keys, F.col("_s")[key].alias("survivor_id"), F.col("_s")[cohort].alias("survivor_cohort"))
    )
    return (
        known.join(groups, list(keys))
        .filter(F.col(cohort) != F.col("survivor_cohort"))
        .select("survivor_id", F.col(key).alias("matched_id"), "survivor_cohort", F.col(cohort).alias("matched_cohort"))
    )


def patch_rows(df: DataFrame, pairs: DataFrame, cols: Sequence[str], key: str = "global_id") -> DataFrame:
    """Fill nulls of a surviving row from its matched rows (least matched id with a value first)."""
    links = pairs.select("survivor_id", F.col("matched_id").alias(key))
    donors = df.select(key, *cols).join(links, key)
    value = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(key))).alias(f"_{c}") for c in cols
    ]
    best = donors.groupBy(F.col("survivor_id").alias(key)).agg(*value)
    patched = df.join(best, key, "left").withColumns({c: F.coalesce(c, f"_{c}") for c in cols})
    return patched.drop(*[f"_{c}" for c in cols])


def remove_rows(df: DataFrame, drops: DataFrame, key: str = "global_id") -> DataFrame:
    return df.join(drops.select(key).distinct(), key, "left_anti")


def dedupe_completion(rows: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per (student, completion, item)."""
    return distinct_first(rows, keys, order)


# ---- timing --------------------------------------------------------------

def student_timing(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows, elapsed seconds and mean seconds per step of every student.

    The mean step is elapsed / (n - 1): the sum of all steps telescopes, so no ordering
    of a student's rows is needed and a hot student is pre-aggregated.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    per = rows.groupBy(key).agg(
        F.count(ts).alias("n_rows"), ((F.max(micros) - F.min(micros)) / 1e6).alias("elapsed_seconds")
    )
    return per.withColumn(
        "mean_step_seconds", F.try_divide(F.col("elapsed_seconds"), F.col("n_rows") - 1)
    )


def item_timing(rows: DataFrame, key: str, ts: str, bucket_seconds: int = 3600) -> DataFrame:
    """Seconds since the student's previous row; null on the first, and without a time or student.

    Every row stays.  The window runs inside (student, time bucket), so one student's rows are spread over
    many tasks.  Only the last time of each earlier bucket crosses the bucket border.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    timed = rows.withColumns(
        {"_us": micros, "_bucket": F.floor(micros / F.lit(bucket_seconds * 1_000_000))}
    )
    known = F.col(key).isNotNull() & F.col("_us").isNotNull()
    ends = timed.filter(known).groupBy(key, "_bucket").agg(F.max("_us").alias("_end"))
    by_bucket = W.partitionBy(key).orderBy("_bucket")
    carry = ends.select(key, "_bucket", F.lag("_end").over(by_bucket).alias("_carry"))
    in_bucket = W.partitionBy(key, "_bucket").orderBy("_us")
    stepped = timed.withColumn("_prev", F.lag("_us").over(in_bucket)).join(carry, [key, "_bucket"], "left")
    step = F.when(known, (F.col("_us") - F.coalesce("_prev", "_carry")) / 1e6)
    return stepped.withColumn("step_seconds", step).drop("_us", "_bucket", "_prev", "_carry")
