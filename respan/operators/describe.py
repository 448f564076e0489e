"""Descriptive statistics, correlations, subgroup summaries and the data behind plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from respan.functions.columns import pair_difference
from respan.operators.quantiles import exact_quantiles, per_group

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def number(name: str) -> Column:
    """The column as double, NaN as null: both count as missing."""
    v = F.col(name).cast("double")
    return F.when(~F.isnan(v), v)


def one_row_to_rows(df: DataFrame, label: str, rows: dict[str, dict[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry: label -> {output column: input column}."""
    items = F.array(
        *[
            F.struct(F.lit(name).alias(label), *[F.col(src).alias(out) for out, src in cols.items()])
            for name, cols in rows.items()
        ]
    )
    return df.select(F.explode(items).alias("_r")).select("_r.*")


def unpivot_numbers(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*keys, *[number(c).alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), "variable", "value")


def categorical_descriptives(
    df: DataFrame, variables: Sequence[str], levels: DataFrame | None = None
) -> DataFrame:
    """Count and percent per category; null is a category, and so are unused ``levels``.

    Rows are counted per combination of values first; only that table is unpivoted.
    ``levels`` holds ``variable, category``.
    """
    combos = df.groupBy(*[F.col(v).cast("string").alias(v) for v in variables]).agg(F.count("*").alias("_n"))
    counts = (
        combos.unpivot(["_n"], list(variables), "variable", "category")
        .groupBy("variable", "category")
        .agg(F.sum("_n").alias("n"))
    )
    if levels is not None:
        unused = levels.select("variable", "category").distinct().withColumn("n", F.lit(0).cast("long"))
        counts = counts.unionByName(unused).groupBy("variable", "category").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("variable").agg(F.sum("n").alias("_total"))
    return counts.join(totals, "variable").select(
        "variable", "category", "n", F.try_divide(100.0 * F.col("n"), F.col("_total")).alias("percent")
    )


def numeric_descriptives(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """n, mean, sd, min, q1, median, q3, max per variable."""
    stats = {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(number(v)).alias(f"{v}|{s}") for v in variables for s, f in stats.items()])
    base = one_row_to_rows(wide, "variable", {v: {s: f"`{v}|{s}`" for s in stats} for v in variables})
    q = exact_quantiles(unpivot_numbers(df, variables), ["variable"], "value", QUARTILES)
    return base.join(q, "variable", "left").select(
        "variable", "n", "mean", "sd", "min", "q1", "median", "q3", "max"
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson, pairwise complete; null when either side is constant."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def pairwise_corr(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    wide = df.agg(*[correlation(number(x), number(y)).alias(name) for name, (x, y) in pairs.items()])
    return one_row_to_rows(wide, "comparison", {name: {"correlation": f"`{name}`"} for name in pairs})


def corr_with(df: DataFrame, predictors: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per predictor, one ``cor_<measure>`` column per measure."""
    wide = df.agg(
        *[correlation(number(p), number(m)).alias(f"{p}|{m}") for p in predictors for m in measures]
    )
    rows = {p: {f"cor_{m}": f"`{p}|{m}`" for m in measures} for p in predictors}
    return one_row_to_rows(wide, "predictor", rows)


def diff_summary(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Mean, median, 90th and 95th percentile of absolute differences (name -> column)."""
    wide = df.agg(*[F.avg(number(c)).alias(name) for name, c in measures.items()])
    means = one_row_to_rows(wide, "comparison", {name: {"mean_absdiff": f"`{name}`"} for name in measures})
    named = df.select(*[number(c).alias(name) for name, c in measures.items()])
    long = named.unpivot([], list(measures), "comparison", "value")
    q = exact_quantiles(
        long, ["comparison"], "value", {"median_absdiff": 0.5, "p90_absdiff": 0.9, "p95_absdiff": 0.95}
    )
    return means.join(q, "comparison", "left")


def by_group(df: DataFrame, group_vars: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Row count and means per level of each grouping variable (output name -> column).

    One pass: sums per combination of levels, then the small table is unpivoted and added up.
    """
    sums = []
    for name, c in measures.items():
        sums += [F.sum(number(c)).alias(f"s|{name}"), F.count(number(c)).alias(f"c|{name}")]
    combos = df.groupBy(*[F.col(g).cast("string").alias(g) for g in group_vars]).agg(
        F.count("*").alias("n"), *sums
    )
    carried = [c for c in combos.columns if c not in group_vars]
    long = combos.unpivot([F.col(f"`{c}`") for c in carried], list(group_vars), "grouping_variable", "group_value")
    means = [
        F.try_divide(F.sum(f"`s|{name}`"), F.sum(f"`c|{name}`")).alias(name) for name in measures
    ]
    return long.groupBy("grouping_variable", "group_value").agg(F.sum("n").alias("n"), *means)


# ---- plot data -----------------------------------------------------------

def _bucket(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    # `least` skips nulls, so a missing value needs its own branch
    inside = F.least(F.width_bucket(v, lo, hi, F.lit(bins)).cast("int"), F.lit(bins))
    return F.when(v.isNull(), F.lit(None).cast("int")).when(lo == hi, F.lit(1)).otherwise(inside)


def _ends(df: DataFrame, *cols: str) -> list[tuple[Column, Column]]:
    """(min, max) of the columns as one scalar subquery."""
    limits = df.agg(
        F.struct(*[F.struct(F.min(number(c)), F.max(number(c))).alias(f"e{i}") for i, c in enumerate(cols)])
    ).scalar()
    return [(limits[f"e{i}"]["col1"], limits[f"e{i}"]["col2"]) for i in range(len(cols))]


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins on [min, max]; empty bins are kept."""
    (lo, hi), = _ends(df, col)
    counts = (
        df.select(_bucket(number(col), lo, hi, bins).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count("*").alias("_n"))
    )
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return spine.join(counts, "bin", "left").select(
        "bin",
        (lo + width * (F.col("bin") - 1)).alias("bin_lo"),
        (lo + width * F.col("bin")).alias("bin_hi"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n"),
    )


def box_stats(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 IQR) and the number of outliers."""
    keys = ["variable"] + ([by] if by else [])
    long = unpivot_numbers(df, cols, [by] if by else []).filter(F.col("value").isNotNull())
    q = exact_quantiles(long, keys, "value", QUARTILES)
    iqr = F.col("q3") - F.col("q1")
    fences = per_group(q).withColumns({"_lo": F.col("q1") - 1.5 * iqr, "_hi": F.col("q3") + 1.5 * iqr})
    v = F.col("value")
    inside = v.between(F.col("_lo"), F.col("_hi"))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    out = long.alias("l").join(fences.alias("f"), on)
    return out.groupBy(*[F.col(f"l.{k}").alias(k) for k in keys], "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    a, b = number(x), number(y)
    return df.agg(
        F.regr_count(b, a).alias("n"),
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
    )


def difference_vs_average(df: DataFrame, a: str, b: str, key: str = "global_id") -> DataFrame:
    """Per row: average and difference of two scores, with the mean difference as a line."""
    cols = pair_difference(number(a), number(b))
    mean = df.agg(F.avg(cols["diff"])).scalar()
    return df.select(key, cols["avg"].alias("avg"), cols["diff"].alias("diff"), mean.alias("mean_diff"))


def binned_trend(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """Mean of ``y`` in equal-width bins of ``x``."""
    (lo, hi), = _ends(df, x)
    rows = df.select(_bucket(number(x), lo, hi, bins).alias("bin"), number(y).alias("_y"))
    rows = rows.filter(F.col("bin").isNotNull() & F.col("_y").isNotNull())
    return rows.groupBy("bin").agg(F.count("*").alias("n"), F.avg("_y").alias("mean_y"))


def bin_2d(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Point counts on a grid: a scatter plot of bounded size."""
    (x_lo, x_hi), (y_lo, y_hi) = _ends(df, x, y)
    rows = df.select(
        _bucket(number(x), x_lo, x_hi, bins).alias("x_bin"),
        _bucket(number(y), y_lo, y_hi, bins).alias("y_bin"),
    )
    rows = rows.filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    return rows.groupBy("x_bin", "y_bin").agg(F.count("*").alias("n"))
