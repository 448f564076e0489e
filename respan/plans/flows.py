"""The end-to-end flows, composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from respan.functions.qid import item_lookup
from respan.irt.fit import FittedModel, factor_map, fit_irt, fit_table, item_params, lrt, prepare, score_eap
from respan.irt.m2 import model_stats
from respan.operators import compare, dedupe, describe, matching, rows
from respan.operators.counts import item_counts, item_sample_size
from respan.operators.quality import clean_review
from respan.operators.rows import restrict_items, with_row_id
from respan.operators.selection import selection_metrics, selection_report
from respan.operators.trim import TrimLimits, item_diagnostics, trim_pools, trim_review


def selection_flow(resp: DataFrame, covars: DataFrame, labels: str = "a") -> DataFrame:
    """Responses and respondents to the item-selection report."""
    return selection_report(selection_metrics(item_sample_size(resp, covars), labels=labels), labels=labels)


def review_input(unmatched: DataFrame, fuzzy: DataFrame, manual: DataFrame, bank: DataFrame, k: int = 5) -> DataFrame:
    """Before the human review: one prompt row per uncertain case, with empty review columns."""
    cases = with_row_id(
        matching.audit_cases(unmatched, fuzzy, manual), [("source_name", "asc"), ("question_id", "asc")], "audit_row"
    )
    pool = matching.candidate_pool(cases, bank, k)
    return matching.add_review_shell(matching.prompt_table(pool, cases))


@dataclass
class ReviewResult:
    cases: DataFrame
    patches: DataFrame
    summary: DataFrame
    unresolved: DataFrame


def review_output(completed: DataFrame, cases: DataFrame, bank: DataFrame) -> ReviewResult:
    """After the human review: final ids, patches, summary and what stays open."""
    review = clean_review(completed)
    patches = matching.patch_table(review, bank)
    return ReviewResult(
        matching.final_id(matching.attach_patches(cases, patches)),
        patches,
        matching.patch_summary(review, patches),
        matching.unresolved_cases(review),
    )


@dataclass
class ModelComparison:
    models: dict[str, FittedModel]
    fit: DataFrame
    scores: DataFrame


MODEL_PAIRS = {
    "rasch_2pl": ("theta_rasch", "theta_2pl"),
    "rasch_bif": ("theta_rasch", "theta_bifactor"),
    "2pl_bif": ("theta_2pl", "theta_bifactor"),
}


def compare_flow(resp: DataFrame, covars: DataFrame, how: str = "blocks", packed=None, **fit_options) -> ModelComparison:
    """Fit the three models, and put their scores side by side with the covariates.

    The responses are packed once for all fits and scores (or given as ``packed``).
    """
    packed = packed or prepare(resp)
    factors = factor_map(resp, how)
    models = {k: fit_irt(packed, k, factors, **fit_options) for k in ("rasch", "2pl", "bifactor")}
    scores = [
        score_eap(packed, m).withColumnsRenamed({"theta": f"theta_{k}", "SE_theta": f"SE_theta_{k}"})
        for k, m in models.items()
    ]
    side_by_side = compare.compare_models(compare.attach_scores(covars, *scores), MODEL_PAIRS)
    return ModelComparison(models, fit_table(list(models.values())), side_by_side)


@dataclass
class Trimmed:
    diagnostics: DataFrame
    kept: DataFrame
    dropped: DataFrame
    model: FittedModel
    scores: DataFrame


def trim_flow(
    resp: DataFrame, covars: DataFrame, full: FittedModel, limits: TrimLimits = TrimLimits(),
    reviewed: DataFrame | None = None, **fit_options,
) -> Trimmed:
    """Flag items of a fitted 2PL, refit on the rest, and compare the scores."""
    counts = item_counts(resp).select("QID", "n_responded", "prop_correct")
    diag = item_diagnostics(item_lookup(resp), counts, item_params(full), limits)
    kept, dropped = trim_pools(trim_review(diag, reviewed))
    pool = prepare(restrict_items(resp, kept))
    model = fit_irt(pool, "2pl", name="2pl_trimmed", **fit_options)
    scores = compare.compare_scores(covars, score_eap(resp, full), score_eap(pool, model))
    return Trimmed(diag, kept, dropped, model, scores)


@dataclass
class TrimmedComparison:
    comparison: ModelComparison
    ranks: DataFrame
    tests: DataFrame
    stats: DataFrame
    correlations: DataFrame
    differences: DataFrame
    subgroups: DataFrame


def trimmed_comparison_flow(
    resp: DataFrame, covars: DataFrame, kept: DataFrame, subgroups: tuple[str, ...] = ("gender", "military", "pell"),
    how: str = "qid", **fit_options,
) -> TrimmedComparison:
    """The three models on the retained items: fits, ranks, tests, statistics, and how the scores differ."""
    pool = restrict_items(resp, kept)
    packed = prepare(pool)
    done = compare_flow(pool, covars, how, packed=packed, **fit_options)
    pairs = {name: f"absdiff_{name}" for name in MODEL_PAIRS}
    tests = lrt(done.fit, "rasch", "2pl").unionByName(lrt(done.fit, "2pl", "bifactor"))
    return TrimmedComparison(
        done,
        compare.rank_models(done.fit, "AIC", "BIC"),
        tests,
        model_stats(packed, list(done.models.values())),
        describe.pairwise_corr(done.scores, MODEL_PAIRS),
        describe.diff_summary(done.scores, pairs),
        describe.by_group(done.scores, subgroups, {f"mean_{k}": v for k, v in pairs.items()}),
    )


def prepare_flow(
    first: DataFrame, second: DataFrame, spec: dict[str, str], keys: tuple[str, ...], patch: tuple[str, ...],
    cohort: str = "wave", key: str = "global_id",
) -> DataFrame:
    """Two waves to one respondent table: stack, find duplicates, fill the survivors, drop the copies, finalise."""
    both = rows.stack_waves(first, second, spec)
    pairs = dedupe.duplicate_pairs(both, keys, cohort, key)
    filled = dedupe.patch_rows(both, pairs, patch, key)
    left = dedupe.remove_rows(filled, pairs.select(pairs["matched_id"].alias(key)), key)
    return rows.final_dataset(left) if "college" in left.columns else left


@dataclass
class Description:
    categories: DataFrame
    numbers: DataFrame
    report: DataFrame


def describe_flow(resp: DataFrame, covars: DataFrame, categories: tuple[str, ...], numbers: tuple[str, ...]) -> Description:
    """A prepared respondent table and its responses: levels, numbers and the item-selection report."""
    return Description(
        describe.categorical_descriptives(covars, list(categories)),
        describe.numeric_descriptives(covars, list(numbers)),
        selection_flow(resp, covars),
    )
