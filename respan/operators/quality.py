"""Data-quality gates, missingness and QA summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from respan.functions.columns import clean_text
from respan.operators.rows import filter_not_in, item_columns, missing_columns

# Decisions a reviewer may enter.
DECISIONS = ("accept", "reject", "revise")
APPROVED = ("accept", "revise")


class GateError(ValueError):
    """A hard gate failed."""


@dataclass(frozen=True)
class Gate:
    """A row-level rule: ``violation`` is true on offending rows."""

    name: str
    violation: Column
    severity: str = "stop"


def allowed_values(col: str, values: Iterable, severity: str = "stop") -> Gate:
    """Null is allowed."""
    return Gate(f"{col}_allowed", ~F.col(col).isin(list(values)), severity)


def not_null(col: str, severity: str = "stop") -> Gate:
    return Gate(f"{col}_present", F.col(col).isNull(), severity)


def check(df: DataFrame, gates: Sequence[Gate], sample: str) -> DataFrame:
    """One row per gate: number of offending rows and the least ``sample`` value among them.

    All rules are part of one aggregate, so the table is scanned once.
    """
    aggs, items = [], []
    for i, g in enumerate(gates):
        bad = F.coalesce(g.violation, F.lit(False))
        aggs += [
            F.count_if(bad).alias(f"n{i}"),
            F.min(F.when(bad, F.col(sample).cast("string"))).alias(f"s{i}"),
        ]
        items.append(
            F.struct(
                F.lit(g.name).alias("gate"),
                F.lit(g.severity).alias("severity"),
                F.col(f"n{i}").alias("n_violations"),
                F.col(f"s{i}").alias("sample"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*items)).alias("_g")).select("_g.*")


def response_gates(item: str = "QID", answer: str = "response", key: str = "global_id") -> list[Gate]:
    """Answers are 0, 1 or missing; every row names its respondent and item."""
    return [allowed_values(answer, (0, 1)), not_null(key), not_null(item)]


def failed_casts(raw: DataFrame, cast: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Rows of the gate report for values that a cast turned into null, one row for each column.

    Both tables have a unique ``key``; blank and ``NA`` texts are missing values, not failures.
    """
    names = [f"_{c}" for c in cols]
    given = raw.select(key, *[F.col(c).cast("string").alias(n) for c, n in zip(cols, names)])
    both = given.join(cast.select(key, *cols), key)
    gates = [
        Gate(f"{c}_castable", F.col(n).isNotNull() & ~F.trim(n).isin("", "NA") & F.col(c).isNull(), "warn") for c, n in zip(cols, names)
    ]
    return check(both, gates, key)


def table_gate(spark, name: str, problems: Sequence[str], severity: str = "stop") -> DataFrame:
    """A gate row for a rule on the table as a whole, such as its columns: one violation for each problem."""
    ddl = "gate string, severity string, n_violations long, sample string"
    return spark.createDataFrame([(name, severity, len(problems), min(problems, default=None))], ddl)


def column_gate(df: DataFrame, required: Iterable[str]) -> DataFrame:
    return table_gate(df.sparkSession, "required_columns", missing_columns(df, required))


def item_count_gate(df: DataFrame, n: int) -> DataFrame:
    found = len(item_columns(df))
    return table_gate(df.sparkSession, "item_count", [] if found == n else [f"{found} item columns, expected {n}"])


def item_column_gate(df: DataFrame, required: DataFrame, item: str = "QID") -> DataFrame:
    """One violation for every id of ``required`` that is no column of ``df``; the ids stay on the executors."""
    have = df.sparkSession.createDataFrame([(c,) for c in df.columns], f"`{item}` string")
    lacking = required.select(item).where(F.col(item).isNotNull()).distinct().join(F.broadcast(have), item, "left_anti")  # as wide as the table
    return lacking.agg(F.lit("required_columns").alias("gate"), F.lit("stop").alias("severity"), F.count("*").alias("n_violations"), F.min(item).alias("sample"))


def answered_item_gate(resp: DataFrame, n: int, item: str = "QID", answer: str = "response") -> DataFrame:
    """One violation unless exactly ``n`` items have an answer, counted from the rows."""
    found = resp.where(F.col(answer).isNotNull() & F.col(item).isNotNull()).select(item).distinct().agg(F.count("*").alias("found"))
    wrong = F.col("found") != n
    return found.select(
        F.lit("item_count").alias("gate"), F.lit("stop").alias("severity"), wrong.cast("long").alias("n_violations"),
        F.when(wrong, F.concat(F.col("found").cast("string"), F.lit(f" item columns, expected {n}"))).alias("sample"),
    )


def rows_gate(df: DataFrame, what: str) -> DataFrame:
    """One violation if the table is empty; one aggregate, no rows to the driver."""
    empty = F.count("*") == 0
    return df.agg(
        F.lit(f"{what}_present").alias("gate"), F.lit("stop").alias("severity"), empty.cast("long").alias("n_violations"),
        F.when(empty, F.lit(f"{what} is empty")).alias("sample"),
    )


def enforce(report: DataFrame) -> None:
    """Raise on the first failed hard gate (the report has one row per gate)."""
    for row in report.filter((F.col("severity") == "stop") & (F.col("n_violations") > 0)).limit(1).collect():
        raise GateError(f"{row['gate']}: {row['n_violations']} rows, e.g. {row['sample']}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise GateError(f"duplicate keys in {list(keys)}")
    return df


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise GateError(f"missing required columns: {', '.join(missing)}")
    return df


def require_item_count(df: DataFrame, n: int) -> DataFrame:
    found = len(item_columns(df))
    if found != n:
        raise GateError(f"expected {n} item columns, found {found}")
    return df


def require_rows(df: DataFrame, what: str = "selection") -> DataFrame:
    if df.isEmpty():
        raise GateError(f"{what} is empty")
    return df


def key_mismatch(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of the tables holds (``side`` = left or right).

    One full join of the distinct keys, instead of an anti-join in each direction.
    """
    left = a.select(key).distinct().withColumn("_l", F.lit(True))
    right = b.select(key).distinct().withColumn("_r", F.lit(True))
    both = left.join(right, key, "full").filter(F.col("_l").isNull() | F.col("_r").isNull())
    return both.select(key, F.when(F.col("_l").isNotNull(), "left").otherwise("right").alias("side"))


def clean_review(review: DataFrame) -> DataFrame:
    """Normalise a completed review; the decision column is required."""
    require_columns(
        review,
        ["audit_row", "source_name", "question_id", "domainId", "source_stem",
         "human_final_qid", "human_final_decision"],
    )
    status = clean_text(F.col("audit_status"), lower=False) if "audit_status" in review.columns else F.lit(None)
    return review.withColumns(
        {
            "human_final_decision": clean_text(F.col("human_final_decision")),
            "human_final_qid": clean_text(F.col("human_final_qid"), lower=False),
            "audit_status": status.cast("string"),
        }
    )


def unknown_ids(review: DataFrame, bank: DataFrame) -> DataFrame:
    """Approved rows whose item id the bank does not hold."""
    approved = review.filter(F.col("human_final_decision").isin(*APPROVED))
    keys = bank.select(F.col("QID").alias("human_final_qid"))
    return filter_not_in(approved, "human_final_qid", keys)


def approved_without_id(review: DataFrame) -> DataFrame:
    return review.filter(F.col("human_final_decision").isin(*APPROVED) & F.col("human_final_qid").isNull())


# ---- missingness ---------------------------------------------------------

def missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent per column, in one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, "column_name", "n_missing")
    return long.select(
        "column_name", "n_missing", F.try_divide(100.0 * F.col("n_missing"), F.col("_rows")).alias("pct_missing")
    )


def row_missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """How many rows miss 0, 1, 2, ... of the columns."""
    cols = list(cols or df.columns)
    n = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    return df.select(n.alias("n_missing")).groupBy("n_missing").agg(F.count("*").alias("n_rows"))


_WORD = 60  # columns in one integer of a mask


def missing_masks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``mask``: bits of the missing columns of every row, 60 columns in each integer."""
    words = [cols[at : at + _WORD] for at in range(0, len(cols), _WORD)]
    bits = lambda some: sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(some)), F.lit(0).cast("long"))
    return df.select(F.array(*[bits(w) for w in words]).alias("mask"))


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``missing`` (the columns, comma-joined, "" for none), ``n_missing`` and ``n_rows`` of every pattern of missing columns.

    Rows are counted by mask before the shuffle; names are put to the masks of the pattern table alone.
    """
    counts = missing_masks(df, list(cols)).groupBy("mask").agg(F.count("*").alias("n_rows"))
    names = F.array(*[F.struct(F.lit(i // _WORD).alias("w"), F.lit(i % _WORD).alias("b"), F.lit(c).alias("c")) for i, c in enumerate(cols)])
    held = F.filter(names, lambda x: F.call_function("shiftright", F.get("mask", x["w"]), x["b"]).bitwiseAND(F.lit(1)) == 1)
    return counts.select(F.array_join(F.transform(held, lambda x: x["c"]), ",").alias("missing"), F.size(held).alias("n_missing"), "n_rows")


def co_missingness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_1, column_2, n_rows``: in how many rows both of two columns are missing, for every two that ever are.

    A task sums the cross products of its masks and sends one row for each pair, however many rows it reads.  Columns come in the
    order given; a column with itself counts its missing rows.
    """
    cols = list(cols)

    def run(batches):
        total = np.zeros((len(cols), len(cols)))
        for batch in batches:
            masks = batch["mask"].flatten().to_numpy().reshape(-1, -(-len(cols) // _WORD))
            for at in range(0, len(masks), 4096):
                part = masks[at : at + 4096]
                gone = ((part[:, :, None] >> np.arange(_WORD)) & 1).reshape(len(part), -1)[:, : len(cols)].astype(float)
                total += gone.T @ gone
        i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "n": total[i, j].astype(np.int64)})

    sums = missing_masks(df, cols).mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n_rows"))
    name = lambda at: F.get(F.array(*[F.lit(c) for c in cols]), at)
    return sums.select(name(F.col("i")).alias("column_1"), name(F.col("j")).alias("column_2"), "n_rows")


def group_missingness(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Missing percent of each column within each group."""
    wide = df.groupBy(group).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    long = wide.unpivot([group, "_rows"], list(cols), "column_name", "n_missing")
    return long.select(
        group, "column_name", "n_missing",
        F.try_divide(100.0 * F.col("n_missing"), F.col("_rows")).alias("pct_missing"),
    )


def qa_summary(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct ids, rows beyond the first of their id, rows without an id."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count_if(known).alias("n_ids"),
        F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("n_duplicate_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("n_null_ids"),
    )
