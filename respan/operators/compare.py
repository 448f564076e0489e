"""Score comparison across models and ranking of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from respan.functions.columns import null_last, pair_difference
from respan.operators.rows import distinct_first

# Covariates carried to every score table.
COVARIATES = (
    "source_id", "global_id", "college", "wave", "age", "gender", "ethnicity", "military",
    "pell", "transfer", "readTime",
)


def attach_scores(covars: DataFrame, *scores: DataFrame, key: str = "global_id") -> DataFrame:
    """Covariates with the scores of several models, joined on the respondent.

    All sides are keyed alike, so Spark shuffles the chain of joins by one partitioning.  Of
    several score rows of a respondent the least counts, so no covariate row is doubled.
    """
    out = covars
    for s in scores:
        s = distinct_first(s, [key], [(c, "asc") for c in s.columns if c != key])
        out = out.join(s, key, "left")
    return out


def compare_models(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds ``diff_<name>``, ``absdiff_<name>``, ``avg_<name>`` per pair of score columns."""
    cols = {}
    for name, (a, b) in pairs.items():
        for kind, c in pair_difference(F.col(a), F.col(b)).items():
            cols[f"{kind}_{name}"] = c
    return df.withColumns(cols)


def compare_scores(
    covars: DataFrame, full: DataFrame, trimmed: DataFrame, key: str = "global_id"
) -> DataFrame:
    """Full-bank against trimmed-bank scores (tables ``global_id, theta, SE_theta``)."""
    f = full.select(key, F.col("theta").alias("theta_full"), F.col("SE_theta").alias("SE_theta_full"))
    t = trimmed.select(key, F.col("theta").alias("theta_trimmed"), F.col("SE_theta").alias("SE_theta_trimmed"))
    both = attach_scores(covars, f, t, key=key)
    return compare_models(both, {"full_trimmed": ("theta_full", "theta_trimmed")})


def rank_models(fit: DataFrame, *by: str) -> DataFrame:
    """Rank of each model, smallest criterion first (the fit table has one row per model)."""
    w = W.orderBy(*[null_last(c, "asc") for c in by], F.col("model"))
    return fit.withColumn("model_rank", F.row_number().over(w))
