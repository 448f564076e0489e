"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from respan.operators.rows import distinct_first, project_tolerant, stack

# Column types of the tables that cross a file boundary.
BANK_TYPES = {"stem": "string", "domain": "string", "QID": "string"}
RESPONSE_TYPES = {"global_id": "string", "QID": "string", "response": "int"}
PARAM_TYPES = {"QID": "string", "a": "double", "b": "double", "g": "double", "u": "double"}


def read_table_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; blank and ``NA`` fields are null; text may hold quotes.

    With ``multi_line`` text may hold newlines, but a file is then read by one task; use Parquet, or
    many files, for anything large.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "NA")
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})


def _read(spark: SparkSession, path: str, fmt: str, types: dict[str, str]) -> DataFrame:
    if fmt == "csv":
        return read_table_csv(spark, path, ", ".join(f"`{c}` {t}" for c, t in types.items()))
    return project_tolerant(spark.read.format(fmt).load(path), types)


def read_item_bank(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Item bank with a unique QID; of repeated ids the first by domain and stem stays."""
    bank = _read(spark, path, fmt, BANK_TYPES)
    return distinct_first(bank, ["QID"], [("domain", "asc"), ("stem", "asc")])


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_item_params(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, PARAM_TYPES)


def read_raw_bundle(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Several raw files as one table; columns a file lacks are null."""
    return stack(*[spark.read.format(fmt).load(p) for p in paths])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> str:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # quote every field, so an empty string and a null stay different, and keep outer spaces
        writer = writer.option("header", True).option("nullValue", "NA").option("escape", '"').option("quoteAll", True)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def save_both(df: DataFrame, folder: str, name: str) -> tuple[str, str]:
    """One table as Parquet and CSV.  The CSV is written from the Parquet copy, so the
    table is computed once."""
    base = f"{folder.rstrip('/')}/{name}"
    parquet = write_table(df, f"{base}.parquet")
    csv = write_table(df.sparkSession.read.parquet(parquet), f"{base}.csv", "csv")
    return parquet, csv


def write_model(params: DataFrame, fit: DataFrame, path: str, factor_map: DataFrame | None = None) -> str:
    """A fitted model as Parquet tables."""
    root = path.rstrip("/")
    write_table(params, f"{root}/item_params")
    write_table(fit, f"{root}/fit")
    if factor_map is not None:
        write_table(factor_map, f"{root}/factor_map")
    return root
