"""Item-selection tables: how many items per domain pass a response threshold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from respan.functions.columns import is_blank_level
from respan.functions.qid import domain_code, domain_label, domain_order


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    metric: str
    threshold: int
    subtitle: str


# The six tables, their thresholds and subtitles.
SELECTION_SPECS = (
    TableSpec("IRT_Frequentist_300", "overall_n", 300,
              "IRT 2PL Fit: minimum recommended frequentist threshold = 300 responses"),
    TableSpec("IRT_Bayesian_150", "overall_n", 150,
              "IRT 2PL Fit: minimum with Bayesian stabilization = 150 responses"),
    TableSpec("DIF_Frequentist_200", "min_dif_n", 200,
              "Multivariable DIF: minimum recommended frequentist threshold = 200 per gender/military group"),
    TableSpec("DIF_Bayesian_50", "min_dif_n", 50,
              "Multivariable DIF: minimum with Bayesian stabilization = 50 per gender/military group"),
    TableSpec("FactorLevel_Freq_100", "min_factor_n", 100,
              "Factor level: minimum recommended frequentist threshold = 100 per factor level"),
    TableSpec("FactorLevel_Bayes_40", "min_factor_n", 40,
              "Factor level: minimum with Bayesian stabilization = 40 per factor level"),
)


def selection_metrics(
    counts: DataFrame,
    dif: Sequence[str] = ("gender", "military"),
    factors: Sequence[str] | None = None,
    labels: str = "a",
) -> DataFrame:
    """Per item: overall size, smallest group of the ``dif`` demographics, smallest factor level.

    ``factors=None`` looks at all demographics.  Two chained aggregations on (QID,
    demographic) and QID give all three metrics without a join.
    """
    level = ~is_blank_level(F.col("group_value"))
    n, demo = F.col("n_responded"), F.col("demographic")
    in_factors = F.lit(True) if factors is None else demo.isin(list(factors))
    per_demo = counts.groupBy("QID", "demographic").agg(
        F.sum(n).alias("_sum"), F.min(F.when(level, n)).alias("_min")
    )
    return (
        per_demo.groupBy("QID")
        .agg(
            F.max("_sum").alias("overall_n"),
            F.min(F.when(demo.isin(list(dif)), F.col("_min"))).alias("min_dif_n"),
            F.min(F.when(in_factors, F.col("_min"))).alias("min_factor_n"),
        )
        .withColumn("domain", domain_label(domain_code(F.col("QID"), strict=labels == "a"), labels))
    )


def domain_spine(df: DataFrame, labels: str = "a") -> DataFrame:
    names = F.array(*[F.lit(d) for d in domain_order(labels)])
    return df.sparkSession.range(1).select(F.explode(names).alias("domain"))


def domain_table(df: DataFrame, metric: str, threshold: int, labels: str = "a") -> DataFrame:
    """Eligible items per domain, empty domains as zero, and a Total row."""
    hits = df.filter(F.col(metric) >= threshold).groupBy("domain").agg(F.count("*").alias("n_items"))
    return with_total(on_spine(hits, labels).select("domain", F.coalesce("n_items", F.lit(0)).alias("n_items")))


def on_spine(hits: DataFrame, labels: str) -> DataFrame:
    """One row per domain; the counts are null where no item passed.

    Null-safe on purpose: a plain equality lets Spark push "domain is not null" - a regular
    expression over the item id - below every aggregation, down to the response rows.
    """
    spine = domain_spine(hits, labels).withColumnRenamed("domain", "_domain")
    return spine.join(hits, F.col("_domain").eqNullSafe(F.col("domain")), "left").drop("domain").withColumnRenamed(
        "_domain", "domain"
    )


def with_total(table: DataFrame, *by: str) -> DataFrame:
    total = table.groupBy(*by).agg(F.sum("n_items").alias("n_items")).withColumn("domain", F.lit("Total"))
    return table.unionByName(total)


def selection_tables(
    metrics: DataFrame, specs: Sequence[TableSpec] = SELECTION_SPECS, labels: str = "a"
) -> DataFrame:
    """All threshold tables from one aggregation over the metrics."""
    flags = [F.count_if(F.col(s.metric) >= s.threshold).alias(s.table_name) for s in specs]
    hits = metrics.groupBy("domain").agg(*flags)
    long = on_spine(hits, labels).unpivot(["domain"], [s.table_name for s in specs], "table_name", "n_items")
    long = long.withColumn("n_items", F.coalesce("n_items", F.lit(0)))
    return with_total(long, "table_name").select("table_name", "domain", "n_items")


def selection_report(
    metrics: DataFrame, specs: Sequence[TableSpec] = SELECTION_SPECS, labels: str = "a"
) -> DataFrame:
    """The tables with their subtitles as one long table; write it by ``table_name``."""
    subtitle = F.create_map(*[x for s in specs for x in (F.lit(s.table_name), F.lit(s.subtitle))])
    return selection_tables(metrics, specs, labels).select(
        "table_name", subtitle[F.col("table_name")].alias("subtitle"), "domain", "n_items"
    )
