"""Matching uncertain items to the item bank, with a human review step in between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from respan.functions.columns import clean_text, paste_cols
from respan.operators.nearstem import nearest_stems, similar_stems
from respan.operators.quality import APPROVED, DECISIONS
from respan.operators.rows import distinct_first, filter_in, project_tolerant, stack

# Columns and types of the review tables.
CASE_TYPES = {
    "source_name": "string", "question_id": "string", "domainId": "string", "stem": "string",
    "QID": "string", "match_method": "string", "string_distance": "double", "audit_reason": "string",
}
REVIEW_COLUMNS = (
    "llm_suggested_qid", "llm_confidence", "llm_rationale", "human_final_decision", "human_final_qid",
)


# ---- audit cases ---------------------------------------------------------

def audit_cases(
    unmatched: DataFrame, fuzzy: DataFrame, manual: DataFrame, max_distance: float = 0.08
) -> DataFrame:
    """Rows that need a second look; of a repeated case the unmatched version wins, then fuzzy."""

    def tagged(df: DataFrame, reason: str, priority: int) -> DataFrame:
        tagged_rows = df.withColumn("audit_reason", F.lit(reason))
        return project_tolerant(tagged_rows, CASE_TYPES).withColumn("_priority", F.lit(priority))

    cases = stack(
        tagged(unmatched, "unmatched_after_exact_fuzzy", 1),
        tagged(fuzzy.filter(F.col("string_distance") >= max_distance), "high_distance_fuzzy_match", 2),
        tagged(manual.filter(F.col("match_method") == "manual_repair"), "manual_repair_secondary_check", 3),
    )
    order = [("_priority", "asc"), ("stem", "asc"), ("QID", "asc")]
    return distinct_first(cases, ["source_name", "question_id"], order).drop("_priority")


def add_review_shell(df: DataFrame) -> DataFrame:
    """Empty review columns and the status ``pending``."""
    shell = {c: F.lit(None).cast("string") for c in REVIEW_COLUMNS}
    return df.withColumns({**shell, "audit_status": F.lit("pending")})


# ---- candidates ----------------------------------------------------------

def candidate_pool(cases: DataFrame, bank: DataFrame, k: int = 5, n_cases: int | None = None) -> DataFrame:
    """k best bank items per case, inside the case's domain when it names one.

    Copies of a case are matched once: the work is per distinct (domain, stem), and a case that names a domain meets
    blocks of that domain alone.  Counts the cases (unless ``n_cases`` is given) and searches in two rounds at once.  A case
    without any candidate keeps one row of nulls; a case without a stem gets the first
    items by QID, unscored.
    """
    domain, stem = F.nullif(F.lower("domainId"), F.lit("")), F.nullif(F.lower("stem"), F.lit(""))
    keyed = cases.withColumns({"domain_key": domain, "stem_key": stem})
    probes = keyed.select("domain_key", "stem_key").distinct()
    best = nearest_stems(probes, bank, k, n_cases if n_cases is not None else cases.count())
    on = F.col("c.domain_key").eqNullSafe(F.col("b.domain_key")) & F.col("c.stem_key").eqNullSafe(F.col("b.stem_key"))
    joined = keyed.alias("c").join(best.alias("b"), on, "left")
    return joined.select(
        "c.audit_row", "c.source_name", "c.question_id", "c.domainId", F.col("c.stem").alias("source_stem"),
        "b.candidate_rank", "b.candidate_QID", "b.candidate_domain", "b.candidate_stem",
        "b.similarity_jw", "b.distance_lv",
    )


def prompt_table(pool: DataFrame, cases: DataFrame | None = None) -> DataFrame:
    """One text per case listing its candidates in rank order (at most k lines)."""
    line = paste_cols(
        F.col("candidate_rank"), F.lit(". "), F.col("candidate_QID"), F.lit(" ["),
        F.col("candidate_domain"), F.lit("]: "), F.col("candidate_stem"),
    )
    lines = F.array_sort(F.collect_list(F.struct(F.coalesce("candidate_rank", F.lit(0)).alias("r"), line.alias("t"))))
    out = pool.groupBy("audit_row", "source_name", "question_id", "domainId", "source_stem").agg(
        F.array_join(lines["t"], "\n").alias("candidates_text")
    )
    if cases is None:
        return out
    extra = cases.select("audit_row", "audit_reason", F.col("QID").alias("current_QID"), "match_method", "string_distance")
    return out.join(extra, "audit_row", "left")


# ---- after the review ----------------------------------------------------

def patch_table(review: DataFrame, bank: DataFrame) -> DataFrame:
    """Approved ids that the bank holds, one row per case (the least audit row first)."""
    approved = review.filter(
        F.col("human_final_decision").isin(*APPROVED) & F.col("human_final_qid").isNotNull()
    )
    valid = filter_in(approved, "human_final_qid", bank.select(F.col("QID").alias("human_final_qid")))
    first = distinct_first(valid, ["source_name", "question_id"], [("audit_row", "asc")])
    return first.select(
        "source_name", "question_id", "domainId", F.col("source_stem").alias("stem"),
        F.col("human_final_qid").alias("approved_QID"),
        F.lit("llm_human_review").alias("approval_source"), "human_final_decision",
    )


def repair_table(patches: DataFrame) -> DataFrame:
    """Approved patches in the shape of a manual repair table."""
    return patches.select(
        "source_name", "question_id", "domainId", "stem", F.col("approved_QID").alias("QID"),
        F.lit("llm_human_review").alias("match_method"),
    )


def attach_patches(cases: DataFrame, patches: DataFrame) -> DataFrame:
    """Cases with their approved id; the key columns match null to null."""
    p = patches.select("source_name", "question_id", "approved_QID", "approval_source", "human_final_decision")
    on = F.col("c.source_name").eqNullSafe(F.col("p.source_name")) & F.col("c.question_id").eqNullSafe(
        F.col("p.question_id")
    )
    keep = [F.col(f"c.{c}") for c in cases.columns if c != "human_final_decision"]
    return cases.alias("c").join(p.alias("p"), on, "left").select(
        *keep, "p.approved_QID", "p.approval_source", "p.human_final_decision"
    )


def final_id(df: DataFrame) -> DataFrame:
    """Approved id, else the existing one, else null; the method likewise."""
    have = df.columns
    old_id = F.col("QID") if "QID" in have else F.lit(None).cast("string")
    old_method = F.col("match_method") if "match_method" in have else F.lit(None).cast("string")
    approved = F.col("approved_QID").isNotNull()
    return df.withColumns(
        {
            "final_QID": F.coalesce("approved_QID", old_id),
            "final_match_method": F.when(approved, "llm_human_review").otherwise(old_method),
        }
    )


def unresolved_cases(review: DataFrame) -> DataFrame:
    decision = F.col("human_final_decision")
    return review.filter(
        (decision == "reject")
        | decision.isNull()
        | (decision.isin(*APPROVED) & F.col("human_final_qid").isNull())
    )


def review_summary(review: DataFrame) -> DataFrame:
    return review.groupBy("human_final_decision").agg(F.count("*").alias("n_rows"))


def patch_summary(review: DataFrame, patches: DataFrame) -> DataFrame:
    """Reviewed rows by decision and the number of final patches, one row."""
    decision = F.col("human_final_decision")
    n_patches = patches.agg(F.count("*")).scalar()
    return review.agg(
        F.count("*").alias("n_total_reviewed"),
        *[F.count_if(decision == d).alias(f"n_{d}") for d in DECISIONS],
    ).select("*", n_patches.alias("n_final_patches"))


# ---- staged identity -----------------------------------------------------

def stem_key(stem: Column) -> Column:
    """Stem for exact comparison: lower case, single spaces."""
    return clean_text(F.regexp_replace(stem, r"\s+", " "))


def match_items(
    templates: DataFrame, bank: DataFrame, repairs: DataFrame, max_distance: float = 0.2
) -> DataFrame:
    """Item identity in stages: exact stem, then nearest stem, then manual repair.

    A case that names a domain is matched inside it in the first two stages; one that names none
    takes the least id of any domain.  Runs the search for similar stems at once: only stems whose
    length and letters allow ``max_distance`` are compared.  Adds ``QID``, ``match_method`` (exact / fuzzy / manual_repair / null) and
    ``string_distance`` (1 - similarity of the fuzzy stage).
    """
    domain = lambda c: F.coalesce(F.lower(c), F.lit(""))
    stems = bank.select(stem_key(F.col("stem")).alias("_k"), domain(F.col("domain")).alias("_d"), "QID").filter(F.col("_k").isNotNull())
    anywhere = stems.withColumn("_d", F.lit(""))
    keys = stems.filter("_d <> ''").unionByName(anywhere).groupBy("_k", "_d").agg(F.min("QID").alias("exact_QID"))
    keyed_templates = templates.withColumns({"_k": stem_key(F.col("stem")), "_d": domain(F.col("domainId"))})
    staged = keyed_templates.join(keys, ["_k", "_d"], "left").drop("_k", "_d")
    open_cases = staged.filter(F.col("exact_QID").isNull() & (F.col("stem") != ""))
    keyed = open_cases.select(
        F.nullif(F.lower("domainId"), F.lit("")).alias("domain_key"), F.lower("stem").alias("stem_key")
    ).distinct()
    found = similar_stems(keyed, bank, 1.0 - max_distance - 1e-9, templates.count(), k=1)
    first = F.min(F.struct((-F.col("similarity_jw")).alias("s"), F.col("distance_lv").alias("d"), F.col("candidate_QID").alias("q"))).alias("b")
    near = found.groupBy("domain_key", "stem_key").agg(first).select(
        "domain_key", "stem_key", F.col("b.q").alias("fuzzy_QID"), (1.0 + F.col("b.s")).alias("string_distance"),
    )
    fixed = repairs.select("source_name", "question_id", F.col("QID").alias("repair_QID"))
    fixed = distinct_first(fixed, ["source_name", "question_id"], [("repair_QID", "asc")])
    on = F.nullif(F.lower("s.domainId"), F.lit("")).eqNullSafe(F.col("n.domain_key")) & (
        F.lower("s.stem") == F.col("n.stem_key")
    )
    joined = staged.alias("s").join(near.alias("n"), on, "left").join(
        fixed.alias("r"),
        F.col("s.source_name").eqNullSafe(F.col("r.source_name"))
        & F.col("s.question_id").eqNullSafe(F.col("r.question_id")),
        "left",
    )
    exact = F.col("s.exact_QID")
    distance = F.when(exact.isNull(), F.col("n.string_distance"))
    fuzzy = F.when(distance <= max_distance, F.col("n.fuzzy_QID"))
    repair = F.col("r.repair_QID")
    return joined.select(
        "s.source_name", "s.question_id", "s.domainId", "s.stem",
        F.coalesce(exact, fuzzy, repair).alias("QID"),
        F.when(exact.isNotNull(), "exact").when(fuzzy.isNotNull(), "fuzzy")
        .when(repair.isNotNull(), "manual_repair").alias("match_method"),
        F.when(fuzzy.isNotNull(), distance).alias("string_distance"),
    )


def staged_outputs(matched: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables that ``audit_cases`` takes: unmatched, fuzzy to review, and after manual repair."""
    method = F.col("match_method")
    return matched.filter(method.isNull()), matched.filter(method == "fuzzy"), matched.filter(method == "manual_repair")
