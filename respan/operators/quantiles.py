"""Exact quantiles of large columns.

``percentile`` keeps every distinct value of a group in one task.  That is fine for an
item-sized table; for respondent-sized columns the rank is bracketed first with a
mergeable sketch and only the few values inside the bracket are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

SKETCH_ACCURACY = 10_000
SMALL_GROUP = 100_000  # at most this many rows: order the whole group
BROADCAST_GROUPS = 10_000  # a table of one row per group is broadcast up to this many groups


def per_group(table: DataFrame) -> DataFrame:
    """A table of one row per group, for a join with the data: computed now and broadcast if it is small.

    Spark cannot know that an aggregate over a few variables has a few rows, and would shuffle the
    data by group, all rows of a variable into one task.  Beyond BROADCAST_GROUPS groups the table
    is returned as it is.
    """
    rows = table.limit(BROADCAST_GROUPS + 1).collect()
    if len(rows) > BROADCAST_GROUPS:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """``keys`` plus one column per entry of ``probs``, linearly interpolated.

    The sketch is off by at most n / SKETCH_ACCURACY ranks, so four of those on either side
    hold the wanted ranks once n is above ``small_group``.  Values below the bracket are only counted.
    The sketch pass runs at once.
    """
    names, ps = list(probs), list(probs.values())
    margin = 4.0 / SKETCH_ACCURACY
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))

    def sketch(sign: int):
        at = [min(max(p + sign * margin, 0.0), 1.0) for p in ps]
        return F.percentile_approx("_v", at, SKETCH_ACCURACY)

    keyed = keys or ["_all"]
    if not keys:
        rows = rows.withColumn("_all", F.lit(1))
    ends = rows.groupBy(*keyed).agg(
        F.count("*").alias("_n"), sketch(-1).alias("_lo"), sketch(1).alias("_hi")
    )
    ends = per_group(ends)
    small = F.col("_n") <= small_group
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keyed]
    v = F.col("_v")
    inside, region = small, F.lit(0)
    for i in range(len(ps)):
        lo, hi = F.col("_lo")[i], F.col("_hi")[i]
        inside = inside | v.between(lo, hi)
        region = region + (v >= lo).cast("int") + (v > hi).cast("int")
    # Cut points split the line into ordered regions.  Inside a bracket one row per distinct
    # value remains, outside one row per region.
    counts = (
        rows.alias("r")
        .join(ends.alias("e"), on)
        .select(*[F.col(f"r.{k}").alias(k) for k in keyed], "_n", region.alias("_region"), F.when(inside, v).alias("_v"))
        .groupBy(*keyed, "_n", "_region", "_v")
        .agg(F.count("*").alias("_c"))
    )
    w = W.partitionBy(*keyed).orderBy("_region", F.col("_v").asc_nulls_first())
    ranked = counts.withColumn("_cum", F.sum("_c").over(w))
    answers = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        below = F.min_by("_v", F.when(F.col("_cum") > F.floor(at), F.col("_cum")))
        above = F.min_by("_v", F.when(F.col("_cum") > F.ceil(at), F.col("_cum")))
        share = F.max(at - F.floor(at))
        # a rank outside the brackets would be a broken sketch: stop, never guess
        lost = F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")
        exact = below + share * (above - below)
        answers.append(F.when(below.isNull() | above.isNull(), lost).otherwise(exact).alias(name))
    out = ranked.groupBy(*keyed).agg(*answers)
    return out if keys else out.drop("_all")
