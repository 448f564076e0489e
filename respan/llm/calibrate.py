"""Thresholds from held-out rows, whatever their number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

SLICES = 4096  # of the scores from 0 to 1


def least_right_scores(held: DataFrame, precision: float) -> dict[str, float]:
    """For each ``kind`` of held (kind, score, label) the lowest score from which on the share ``precision`` of the labels is 1; none if there is none.

    Rows of one score count together.  Scores are ranked inside slices of their range; the sums of the slices, a bounded
    number for each kind, tell what lies above.
    """
    at = F.floor(F.col("score") * SLICES)
    scores = held.groupBy("kind", "score").agg(F.count("*").alias("n"), F.sum("label").alias("right")).withColumn("slice", at)
    sums = scores.groupBy("kind", "slice").agg(F.sum("n").alias("n"), F.sum("right").alias("right"))
    above = W.partitionBy("kind").orderBy(F.desc("slice")).rowsBetween(W.unboundedPreceding, -1)
    before = sums.select("kind", "slice", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "right")])
    inside = W.partitionBy("kind", "slice").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = scores.select("kind", "slice", "score", *[F.sum(c).over(inside).alias(c) for c in ("n", "right")])
    ranked = ranked.join(F.broadcast(before), ["kind", "slice"])  # at most SLICES + 1 rows for each kind
    reached = ranked.where(F.col("right") + F.col("right_above") >= precision * (F.col("n") + F.col("n_above")))
    return {r.kind: r.score for r in reached.groupBy("kind").agg(F.min("score").alias("score")).collect()}
