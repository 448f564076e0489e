"""Row selection, ordering, stacking and numbering."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from respan.functions.columns import clean_text, is_blank_level, null_last
from respan.functions.qid import ITEM_PATTERN
from respan.lineage import cut_lineage

import re

Order = Sequence[tuple[str, str]]


# ---- columns -------------------------------------------------------------

def item_columns(df: DataFrame, pattern: str = ITEM_PATTERN) -> list[str]:
    return [c for c in df.columns if re.match(pattern, c)]


def cast_items(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast item columns to integer; what is no integer becomes null."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("int") for c in cols})


def project_tolerant(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Columns of ``spec`` (name -> type): taken if present, else typed null."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c)
            for c, t in spec.items()
        ]
    )


# ---- filters -------------------------------------------------------------

def subset(df: DataFrame, **allowed: Iterable) -> DataFrame:
    """Keep rows whose columns hold one of the listed values; nulls drop."""
    for name, values in allowed.items():
        df = df.filter(F.col(name).isin(list(values)))
    return df


def filter_at_least(df: DataFrame, metric: str, threshold: float) -> DataFrame:
    return df.filter(F.col(metric) >= threshold)


def filter_in(df: DataFrame, col: str, allowed) -> DataFrame:
    """Membership in a literal list or in the same-named column of a key table."""
    if isinstance(allowed, DataFrame):
        return df.join(allowed.select(col).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(list(allowed)))


def filter_not_in(df: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """Rows with a non-null key that the key table does not hold."""
    return df.filter(F.col(col).isNotNull()).join(keys.select(col).distinct(), col, "left_anti")


def drop_blank_levels(df: DataFrame, col: str) -> DataFrame:
    return df.filter(~is_blank_level(F.col(col)))


def final_dataset(df: DataFrame, trial: str = "umgc1") -> DataFrame:
    """Drop the trial cohort only (a null college stays); colleges ``ua2`` and ``ua23`` become ``ua``."""
    college = F.col("college")
    return df.filter(~college.eqNullSafe(trial)).withColumn(
        "college", F.when(college.startswith("ua"), "ua").otherwise(college)
    )


def speed_filter(df: DataFrame, min_seconds: float) -> DataFrame:
    """Drop respondents who read implausibly fast; unknown times drop too."""
    return df.filter(F.col("readTime") >= min_seconds)


def retained_responses(resp: DataFrame, bank: DataFrame) -> DataFrame:
    """Answered responses to items of the bank."""
    return filter_in(resp.filter(F.col("response").isNotNull()), "QID", bank)


def restrict_items(resp: DataFrame, pool: DataFrame) -> DataFrame:
    return filter_in(resp, "QID", pool)


# ---- order ---------------------------------------------------------------

def sort_rows(df: DataFrame, order: Order) -> DataFrame:
    """Multi-key sort; nulls last in both directions."""
    return df.orderBy(*[null_last(c, d) for c, d in order])


def sort_numeric_text(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.col(col).try_cast("int").asc_nulls_last(), F.col(col).asc_nulls_last())


def head_rows(df: DataFrame, order: Order, n: int = 30) -> DataFrame:
    return sort_rows(df, order).limit(n)


def distinct_first(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first full row of every key.

    Spark turns ``row_number() = 1`` into a group limit below the shuffle, so a hot key
    sends one row per map task, not its whole group.
    """
    w = W.partitionBy(*keys).orderBy(*[null_last(c, d) for c, d in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_row_id(df: DataFrame, order: Order, name: str = "row_id") -> DataFrame:
    """1..n over a total order, without a one-task window.

    The rows are range-partitioned and numbered inside each partition; the partition sizes
    (one row per partition) give the offsets.  The checkpoint pins the partition numbers,
    so a recomputed task cannot shift them.
    """
    by = [null_last(c, d) for c, d in order]
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    placed = cut_lineage(placed)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("_part", before.alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before")
    )


def testlet_blocks(items: DataFrame, size: int = 6) -> DataFrame:
    """Number the items by QID and put ``size`` consecutive items in a testlet.

    ``items`` is the item list (one row per item), so one window over it is small.
    """
    w = W.orderBy("QID")
    ranked = items.select("QID").distinct().withColumn("item_index", F.row_number().over(w))
    return ranked.withColumn("testlet", F.ceil(F.col("item_index") / size).cast("int"))


testlet_blocks.__test__ = False  # not a pytest case


# ---- stacking ------------------------------------------------------------

def stack(*dfs: DataFrame) -> DataFrame:
    """Row stack by column name; missing columns are null."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def stack_waves(a: DataFrame, b: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cross-wave stack on a common column set and common types."""
    return project_tolerant(a, spec).unionByName(project_tolerant(b, spec))


def item_difference(all_items: DataFrame, kept: DataFrame) -> DataFrame:
    return all_items.select("QID").distinct().join(kept.select("QID").distinct(), "QID", "left_anti")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


# ---- reshape -------------------------------------------------------------

def to_long(df: DataFrame, items: Sequence[str] | None = None, key: str = "global_id") -> DataFrame:
    """Wide to long; unanswered items are dropped."""
    items = list(items or item_columns(df))
    return df.unpivot([key], items, "QID", "response").filter(F.col("response").isNotNull())


def to_wide(resp: DataFrame, items: Sequence[str], key: str = "global_id") -> DataFrame:
    """Long to wide over a known item list (no extra pass to discover it); of several answers to an item the least.

    A respondent's answers are gathered as places and values, and the columns are read from them: what tasks hold and send
    grows with the answers, not with a cell for each item of the bank.
    """
    items = list(items)
    places = {q: i for i, q in enumerate(items)}
    index = resp.sparkSession.createDataFrame([*places.items()], "QID string, _i int")
    given = resp.select(key, "QID", "response").join(F.broadcast(index), "QID", "left")  # the item list of the caller
    known = F.col("_i").isNotNull() & F.col("response").isNotNull()
    pairs = F.collect_set(F.when(known, F.struct(F.col("_i").alias("i"), F.col("response").alias("y"))))
    sets = given.groupBy(key).agg(F.array_sort(pairs).alias("_s"))
    first = sets.select(key, F.filter("_s", lambda c, at: (at == 0) | (F.get("_s", at - 1)["i"] != c["i"])).alias("_s"))
    answers = first.select(key, F.map_from_entries("_s").alias("_m"))
    return answers.select(key, *[F.try_element_at("_m", F.lit(places[q])).alias(q) for q in items])


# ---- respondent covariates -----------------------------------------------

def clean_columns(df: DataFrame, cols: Iterable[str], lower: bool = True) -> DataFrame:
    return df.withColumns({c: clean_text(F.col(c), lower) for c in cols})
