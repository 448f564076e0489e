"""Item ids (``Q`` + three digits + domain code + testlet number) and recodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Domain code -> label, in the two label sets in use.
DOMAIN_LABELS = {
    "a": {
        "id": "identifying_details",
        "in": "inference",
        "l": "language_vocabulary",
        "p": "purpose_point_of_view",
        "s": "summary_synthesis",
    },
    "b": {
        "id": "ideas",
        "in": "inference",
        "l": "language",
        "p": "purpose",
        "s": "structure",
    },
}

# Recodes of the covariates.
ETHNICITY_CLASSES = ("White", "Asian", "Black", "Hispanic", "Other")
YES_WORDS = ("yes", "y", "true", "1")
NO_WORDS = ("no", "n", "false", "0")

ITEM_PATTERN = r"^Q\d{3}"
_STRICT_CODE = r"^Q[0-9]{3}([A-Za-z]+)[0-9]+$"


def domain_order(labels: str = "b") -> list[str]:
    return sorted(DOMAIN_LABELS[labels].values())


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def domain_code(qid: Column, strict: bool = True) -> Column:
    """Domain code of an item id; the lenient form also reads a bare code."""
    if strict:
        return blank_to_null(F.regexp_extract(qid, _STRICT_CODE, 1))
    bare = F.regexp_replace(F.regexp_replace(qid, "^Q[0-9]{3}", ""), "[0-9]+$", "")
    return F.lower(bare)


def testlet(qid: Column) -> Column:
    return blank_to_null(F.regexp_extract(qid, "[0-9]+$", 0))


testlet.__test__ = False  # not a pytest case


def recode(col: Column, mapping: dict[str, str], otherwise: Column | None = None) -> Column:
    """Multi-branch recode; values outside the mapping become ``otherwise`` or null.

    A literal map evaluates ``col`` once, where a chain of branches would repeat it.
    """
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    out = F.try_element_at(table, col)
    return out if otherwise is None else F.coalesce(out, otherwise)


def domain_label(code: Column, labels: str = "b") -> Column:
    return recode(code, DOMAIN_LABELS[labels])


def item_lookup(items: DataFrame, labels: str = "b") -> DataFrame:
    """QID, testlet, domain_code, domain: one row per distinct item."""
    qid = F.col("QID")
    return items.select("QID").distinct().select(
        "QID",
        testlet(qid).alias("testlet"),
        domain_code(qid).alias("domain_code"),
        domain_label(domain_code(qid), labels).alias("domain"),
    )


def age_group(age: Column, cut: int = 24) -> Column:
    return F.when(age < cut, "TCAUS").when(age >= cut, "AUS")


def recode_ethnicity(col: Column) -> Column:
    """Known classes keep their name in any letter case; other text is ``Other``."""
    clean = F.lower(F.trim(col))
    known = {name.lower(): name for name in ETHNICITY_CLASSES}
    return F.when(clean.isNotNull() & (clean != "") & (clean != "na"), recode(clean, known, F.lit("Other")))


def recode_yes_no(col: Column) -> Column:
    clean = F.lower(F.trim(col))
    return F.when(clean.isin(*YES_WORDS), "Yes").when(clean.isin(*NO_WORDS), "No")


def normalize_id(col: Column) -> Column:
    """Upper case, letters and digits only."""
    return F.upper(F.regexp_replace(F.trim(col), "[^0-9A-Za-z]", ""))


def global_id(college: Column, identifier: Column) -> Column:
    return F.concat(F.lower(F.trim(college)), F.lit("_"), normalize_id(identifier))


def harmonize_qid(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace legacy ids by final ids; ``qid_mapped`` reports ids without a mapping.

    ``mapping`` holds ``legacy_QID, QID``; of an id that is mapped more than once the least final
    id counts, so no row is doubled.  It is item-sized; Spark broadcasts it when its measured size
    allows that and shuffles it otherwise.
    """
    m = mapping.groupBy(F.col("legacy_QID").alias("_legacy")).agg(F.min("QID").alias("_final"))
    joined = df.join(m, df["QID"] == m["_legacy"], "left")
    return joined.withColumns(
        {"QID": F.coalesce("_final", "QID"), "qid_mapped": F.col("_final").isNotNull()}
    ).drop("_legacy", "_final")
