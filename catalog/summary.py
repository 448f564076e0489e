"""Queries for counts, descriptives, selection tables, quality gates and plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.basic import numbered_cases, patches, respondents
from catalog.registry import query
from respan.operators.rows import cast_items, to_wide
from respan.operators import compare, counts as ct, dedupe, describe as ds, matching, patterns, quality as qa, selection as sel, smooth

CATEGORIES = ["college", "wave", "age", "gender", "ethnicity", "military", "pell"]
GROUPS = ["college", "wave", "gender", "ethnicity", "military", "pell"]
PAIRS = {
    "rasch_2pl": ("theta_rasch", "theta_2pl"),
    "rasch_bif": ("theta_rasch", "theta_bif"),
    "2pl_bif": ("theta_2pl", "theta_bif"),
}


def sizes(fx):
    return ct.item_sample_size(fx.response, fx.respondent)


def metrics(fx):
    return sel.selection_metrics(sizes(fx))


def compared(fx):
    """Covariates, three scores, and their differences."""
    return compare.compare_models(compare.attach_scores(respondents(fx), fx.scores), PAIRS)


def _quartiles(col: str, suffix: str = "") -> str:
    return ", ".join(
        f"round(quantile_cont({col}, {p}),6)+0.0 as {n}{suffix}" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )


# ---- descriptives --------------------------------------------------------

_LEVELS = "(select 'college' as variable, 'umgc9' as category, 0 as n union all select 'gender', 'X', 0)"


@query(" union all ".join(
    f"select '{v}' as variable, {v}::varchar as category, count(*) as n, round(100.0*count(*)/sum(count(*)) over (),6) as percent from fx_respondent group by {v}"
    for v in CATEGORIES) + f" union all select variable, category, n, 0.0::double from {_LEVELS} l")
def categorical_descriptives(fx):
    levels = fx.respondent.select(
        F.explode(F.array(
            F.struct(F.lit("college").alias("variable"), F.lit("umgc9").alias("category")),
            F.struct(F.lit("gender").alias("variable"), F.lit("X").alias("category")),
        )).alias("l")
    ).select("l.*").distinct()
    return ds.categorical_descriptives(fx.respondent, CATEGORIES, levels)


@query(" union all ".join(
    f"select '{v}' as variable, count({v}) as n, round(avg({v}),6) as mean, round(stddev_samp({v}),6) as sd, min({v})::double as min, {_quartiles(v)}, max({v})::double as max from or_numbers"
    for v in ("age", "transfer", "readTime")))
def numeric_descriptives(fx):
    return ds.numeric_descriptives(respondents(fx), ["age", "transfer", "readTime"])


@query("select 'l_quantity' as variable, " + _quartiles("l_quantity") + " from lineitem union all select 'l_extendedprice', " + _quartiles("l_extendedprice") + " from lineitem")
def exact_quantiles(fx):
    """The two-step quantile on the largest table; the small-group shortcut is switched off."""
    from respan.operators.quantiles import exact_quantiles as quantiles

    long = ds.unpivot_numbers(fx.lineitem, ["l_quantity", "l_extendedprice"])
    return quantiles(long, ["variable"], "value", ds.QUARTILES, small_group=20_000)


# ---- counts --------------------------------------------------------------

@query("select QID, n_responded, n_wrong::bigint as n_wrong, n_correct::bigint as n_correct from or_items")
def item_counts(fx):
    return ct.item_counts(fx.response).select("QID", "n_responded", "n_wrong", "n_correct")


@query("select QID, n_responded, round(prop_correct,6) as prop_correct, round(prop_wrong,6) as prop_wrong from or_items")
def item_proportions(fx):
    return ct.item_counts(fx.response).select("QID", "n_responded", "prop_correct", "prop_wrong")


@query("select QID, demographic, group_value, n_responded from or_counts")
def item_sample_size(fx):
    return sizes(fx)


@query("select QID, overall_n from or_metrics")
def overall_n(fx):
    return ct.overall_n(sizes(fx))


@query("select QID, min_dif_n as min_group_n from or_metrics where min_dif_n is not null")
def min_group_n(fx):
    return ct.min_group_n(sizes(fx), ["gender", "military"])


@query("select QID, min_factor_n as min_any_level_n from or_metrics where min_factor_n is not null")
def min_any_level_n(fx):
    return ct.min_group_n(sizes(fx), None, "min_any_level_n")


@query("select QID, overall_n, min_dif_n, min_factor_n, domain from or_metrics")
def selection_metrics(fx):
    return metrics(fx)


def _table_sql(metric: str, threshold: int, extra: str = "") -> str:
    domains = "['identifying_details','inference','language_vocabulary','purpose_point_of_view','summary_synthesis']"
    full = f"(select d.domain, coalesce(n,0)::bigint as n_items from (select unnest({domains}) as domain) d left join (select domain, count(*) as n from or_metrics where {metric} >= {threshold} group by domain) m using (domain))"
    return f"select {extra}domain, n_items from {full} t union all select {extra}'Total', sum(n_items)::bigint from {full} u"


@query(_table_sql("overall_n", 200))
def domain_table(fx):
    return sel.domain_table(metrics(fx), "overall_n", 200)


@query(" union all ".join(_table_sql(s.metric, s.threshold, f"'{s.table_name}' as table_name, ") for s in sel.SELECTION_SPECS))
def selection_tables(fx):
    return sel.selection_tables(metrics(fx))


@query(" union all ".join(_table_sql(s.metric, s.threshold, f"'{s.table_name}' as table_name, '{s.subtitle}' as subtitle, ") for s in sel.SELECTION_SPECS))
def selection_report(fx):
    return sel.selection_report(metrics(fx))


_SPREAD = "count(*) as n_items, min(n_responded) as min_n, " + _quartiles("n_responded", "_n") + ", max(n_responded) as max_n"


@query(f"select domain, {_SPREAD} from or_items left join or_lookup using (QID) group by domain")
def count_distribution_domain(fx):
    return ct.count_distribution(ct.item_counts(fx.response), "domain")


@query(f"select testlet, {_SPREAD} from or_items left join or_lookup using (QID) group by testlet")
def count_distribution_testlet(fx):
    return ct.count_distribution(ct.item_counts(fx.response), "testlet")


@query(f"select min(n_responded) as min, max(n_responded) as max, round(avg(n_responded),6) as mean, round(stddev_samp(n_responded),6) as sd, {_quartiles('n_responded')} from or_items")
def count_distribution_overall(fx):
    return ct.count_distribution(ct.item_counts(fx.response))


_SUM = "count(*) as n_items, min(n_responded) as min_n, round(quantile_cont(n_responded,0.5),6) as median_n, max(n_responded) as max_n"


@query(f"""select 'overall' as scope, 'all' as level, {_SUM} from or_items
 union all select 'domain', domain, {_SUM} from or_items join or_lookup using (QID) group by domain
 union all select 'testlet', testlet, {_SUM} from or_items join or_lookup using (QID) group by testlet
 union all select demographic, group_value, {_SUM} from or_counts group by demographic, group_value""")
def item_count_summaries(fx):
    return ct.item_count_summaries(fx.response, fx.respondent)


@query("select human_final_decision, count(*) as n_rows from or_review group by human_final_decision")
def review_summary(fx):
    return matching.review_summary(qa.clean_review(fx.review))


@query("select count(*) as n_total_reviewed, count(*) filter (human_final_decision='accept') as n_accept, count(*) filter (human_final_decision='reject') as n_reject, count(*) filter (human_final_decision='revise') as n_revise, (select count(*) from or_patches) as n_final_patches from or_review")
def patch_summary(fx):
    return matching.patch_summary(qa.clean_review(fx.review), patches(fx))


@query("select source_name, question_id, domainId, stem, approved_QID, approval_source, human_final_decision from or_patches")
def patch_table(fx):
    return patches(fx)


@query("select source_name, question_id, domainId, stem, approved_QID as QID, approval_source as match_method from or_patches")
def repair_table(fx):
    return matching.repair_table(patches(fx))


@query("select audit_row, source_name, question_id, domainId, source_stem, string_agg(coalesce(candidate_rank::varchar,'NA')||'. '||coalesce(candidate_QID,'NA')||' ['||coalesce(candidate_domain,'NA')||']: '||coalesce(candidate_stem,'NA'), chr(10) order by candidate_rank) as candidates_text from or_pool group by all")
def prompt_table(fx):
    return matching.prompt_table(matching.candidate_pool(numbered_cases(fx), fx.bank))


@query("""with t as (select 'edited' as src, source_name, question_id, domainId, stem, null as QID, null as match_method, null as string_distance, 'unmatched_after_exact_fuzzy' as audit_reason, 1 as pr from fx_template where source_name <> 'recased'
 union all select 'f', source_name, question_id, domainId, stem, 'Q001s1', 'fuzzy', length(question_id)/50.0, 'high_distance_fuzzy_match', 2 from fx_template where length(question_id)/50.0 >= 0.08
 union all select 'm', source_name, question_id, domainId, stem, 'Q002in1', 'manual_repair', 0.5, 'manual_repair_secondary_check', 3 from fx_template)
 select source_name, question_id, domainId, stem, QID, match_method, round(string_distance::double,6) as string_distance, audit_reason from (select *, row_number() over (partition by source_name, question_id order by pr) as rn from t) x where rn = 1""")
def audit_cases(fx):
    t = fx.template
    fuzzy = t.withColumns(
        {"QID": F.lit("Q001s1"), "match_method": F.lit("fuzzy"), "string_distance": F.length("question_id") / 50}
    )
    manual = t.withColumns(
        {"QID": F.lit("Q002in1"), "match_method": F.lit("manual_repair"), "string_distance": F.lit(0.5)}
    )
    return matching.audit_cases(t.filter("source_name <> 'recased'"), fuzzy, manual)


@query("select wave, count(*) as n from fx_respondent group by wave")
def value_counts(fx):
    from respan.operators.rows import value_counts as counts

    return counts(fx.respondent, "wave")


# ---- correlations and score summaries ------------------------------------

def _corr(x: str, y: str) -> str:
    return f"round(regr_sxy({y},{x})/nullif(sqrt(regr_sxx({y},{x})*regr_syy({y},{x})),0),6)+0.0"


@query(" union all ".join(f"select '{n}' as comparison, {_corr(a, b)} as correlation from or_compare" for n, (a, b) in PAIRS.items()))
def pairwise_corr(fx):
    return ds.pairwise_corr(compared(fx), PAIRS)


@query(" union all ".join(f"select '{p}' as predictor, " + ", ".join(f"{_corr(p, 'absdiff_' + n)} as cor_absdiff_{n}" for n in PAIRS) + " from or_compare" for p in ("age", "transfer")))
def corr_with(fx):
    return ds.corr_with(compared(fx), ["age", "transfer"], [f"absdiff_{n}" for n in PAIRS])


@query(" union all ".join(
    f"select '{n}' as comparison, round(avg(absdiff_{n}),6) as mean_absdiff, round(quantile_cont(absdiff_{n},0.5),6) as median_absdiff, round(quantile_cont(absdiff_{n},0.9),6) as p90_absdiff, round(quantile_cont(absdiff_{n},0.95),6) as p95_absdiff from or_compare"
    for n in PAIRS))
def diff_summary(fx):
    return ds.diff_summary(compared(fx), {n: f"absdiff_{n}" for n in PAIRS})


_MEANS = ", ".join(f"round(avg({k}_{n}),6)+0.0 as mean_{k}_{n}" for n in PAIRS for k in ("diff", "absdiff"))


@query(" union all ".join(f"select '{g}' as grouping_variable, {g} as group_value, count(*) as n, {_MEANS} from or_compare group by {g}" for g in GROUPS))
def theta_by_group(fx):
    return ds.by_group(compared(fx), GROUPS, {f"mean_{k}_{n}": f"{k}_{n}" for n in PAIRS for k in ("diff", "absdiff")})


# ---- quality -------------------------------------------------------------

_MISS = ("age", "gender", "pell", "transfer")


@query(" union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as n_missing, round(100.0*(count(*)-count({c}))/count(*),6) as pct_missing from or_numbers" for c in _MISS))
def missingness(fx):
    return qa.missingness(respondents(fx), _MISS)


@query("select ((age is null)::int + (gender is null)::int + (pell is null)::int + (transfer is null)::int) as n_missing, count(*) as n_rows from or_numbers group by 1")
def row_missingness(fx):
    return qa.row_missingness(respondents(fx), _MISS)


@query(" union all ".join(f"select college, '{c}' as column_name, count(*) - count({c}) as n_missing, round(100.0*(count(*)-count({c}))/count(*),6) as pct_missing from or_numbers group by college" for c in _MISS))
def group_missingness(fx):
    return qa.group_missingness(respondents(fx), "college", _MISS)


@query("""select concat_ws(',', case when age is null then 'age' end, case when gender is null then 'gender' end, case when pell is null then 'pell' end, case when transfer is null then 'transfer' end) as missing,
 ((age is null)::int + (gender is null)::int + (pell is null)::int + (transfer is null)::int) as n_missing, count(*) as n_rows from or_numbers group by all""")
def missing_patterns(fx):
    return qa.missing_patterns(respondents(fx), _MISS)


@query("""with a as (select distinct global_id, QID from fx_response), t as (select count(distinct global_id) as n from a), s as (select QID, count(*) as n from a group by QID),
 b as (select x.QID as q1, y.QID as q2, count(*) as n from a x join a y on x.global_id = y.global_id and x.QID <= y.QID group by all)
 select x.QID as column_1, y.QID as column_2, t.n - x.n - y.n + coalesce(b.n, 0) as n_rows from s x join s y on x.QID <= y.QID cross join t left join b on b.q1 = x.QID and b.q2 = y.QID where t.n - x.n - y.n + coalesce(b.n, 0) > 0""")
def co_missingness(fx):
    """Items that go unanswered together, over the wide table."""
    from catalog.model import item_ids

    seen = {r.QID for r in fx.response.select("QID").distinct().collect()}  # a row for each item
    items = [q for q in item_ids() if q in seen]
    return qa.co_missingness(to_wide(fx.response, items), items)


@query("""with p as (select global_id, count(*) as n_items, sha256(string_agg(QID||'='||response::varchar, ',' order by QID||'='||response::varchar)) as pattern from fx_double_response group by global_id)
 select pattern, n_items, count(*) as n_respondents, min(global_id) as first_id from p group by pattern, n_items having count(*) > 1""")
def score_pattern_groups(fx):
    return patterns.equal_pattern_groups(fx.double_response)


# each answer pattern once, by its least respondent
_CLASSES = """pt as (select global_id, string_agg(QID||'='||response::varchar, ',' order by QID) as pattern, count(*) as n from fx_retest group by global_id),
 cl as (select *, min(global_id) over (partition by pattern) as class_id, count(*) over (partition by pattern) as n_members from pt),
 ce as (select r.* from fx_retest r join cl on r.global_id = cl.class_id and cl.global_id = cl.class_id),
 j as (select x.global_id as a, y.global_id as b, count(*) as n_joint, count(*) filter (x.response <> y.response) as w from ce x join ce y on x.QID = y.QID and x.global_id < y.global_id group by all),
 ln as (select a, b, n_joint, p.n + q.n - 2 * n_joint + w as n_diff from j join pt p on p.global_id = a join pt q on q.global_id = b where n_joint >= 12 and p.n + q.n - 2 * n_joint + w <= 2)"""


@query(f"""with {_CLASSES} select global_id, class_id, n_members, (select count(*) from ln where a = class_id or b = class_id) as n_links from cl""")
def likely_duplicates(fx):
    """Respondents by equal answers, and how many other answer patterns differ in two items at most."""
    from catalog.model import item_ids

    return patterns.likely_duplicates(fx.retest, item_ids())[0]


@query(f"with {_CLASSES} select a, b, n_joint::int as n_joint, n_diff::int as n_diff from ln")
def similar_patterns(fx):
    from catalog.model import item_ids

    return patterns.likely_duplicates(fx.retest, item_ids())[1]


@query("select count(*) as n_rows, count(distinct source_name||question_id) as n_ids, count(*) - count(distinct source_name||question_id) as n_duplicate_rows, 0::bigint as n_null_ids from fx_review")
def qa_summary(fx):
    return qa.qa_summary(fx.review.withColumn("case_id", F.concat("source_name", "question_id")), "case_id")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def unique_key_gate(fx):
    return qa.duplicate_keys(fx.lineitem, ["l_orderkey", "l_linenumber"])


@query("select global_id, 'left' as side from fx_cohorts where cohort = 'trial'")
def key_mismatch_gate(fx):
    return qa.key_mismatch(fx.cohorts, fx.respondent, "global_id")


@query("""select 'human_final_decision_allowed' as gate, 'stop' as severity, count(*) filter (x not in ('accept','revise')) as n_violations, min(audit_row::varchar) filter (x not in ('accept','revise')) as sample from (select *, human_final_decision as x from or_review) t
 union all select 'domainId_present', 'warn', count(*) filter (domainId is null), min(audit_row::varchar) filter (domainId is null) from or_review""")
def check_gates(fx):
    gates = [qa.allowed_values("human_final_decision", ["accept", "revise"]), qa.not_null("domainId", "warn")]
    return qa.check(qa.clean_review(fx.review), gates, "audit_row")


@query("""with r as (select global_id, QID, case when substr(QID,2,3) = '007' then 2 else response end as response from fx_response union all select null, 'Q001in1', 1)
 select 'response_allowed' as gate, 'stop' as severity, count(*) filter (response not in (0,1)) as n_violations, min(global_id) filter (response not in (0,1)) as sample from r
 union all select 'global_id_present', 'stop', count(*) filter (global_id is null), null from r
 union all select 'QID_present', 'stop', count(*) filter (QID is null), null from r""")
def response_gate(fx):
    """Answers outside 0/1 and rows without an id, in a table that has both."""
    wrong = fx.response.withColumn("response", F.when(F.substring("QID", 2, 3) == "007", 2).otherwise(F.col("response")))
    nobody = fx.response.sparkSession.sql("select cast(null as string) as global_id, 'Q001in1' as QID, 1 as response")
    return qa.check(wrong.unionByName(nobody), qa.response_gates(), "global_id")


@query("""select c || '_castable' as gate, 'warn' as severity, count(*) filter (bad) as n_violations, min(global_id) filter (bad) as sample from (
  select 'transfer' as c, global_id, trim(transfer) not in ('','NA') and try_cast(transfer as int) is null as bad from fx_respondent
  union all select 'pell', global_id, trim(pell) not in ('','NA') and try_cast(pell as int) is null from fx_respondent) t group by c""")
def cast_gate(fx):
    """Item-like columns with values that are no integers."""
    raw = fx.respondent.select("global_id", "transfer", "pell")
    return qa.failed_casts(raw, cast_items(raw, ["transfer", "pell"]), ["transfer", "pell"], "global_id")


@query("select 'required_columns' as gate, 'stop' as severity, count(*) as n_violations, min(QID) as sample from (select QID from fx_params union select QID from fx_legacy) t where QID not in (select QID from fx_response)")
def column_gate(fx):
    """Items of the parameter table and renamed legacy items against the columns of the wide answers."""
    from catalog.model import item_ids

    seen = {r.QID for r in fx.response.select("QID").distinct().collect()}  # a row for each item
    wide = to_wide(fx.response, [q for q in item_ids() if q in seen])
    return qa.item_column_gate(wide, fx.params.select("QID").unionByName(fx.legacy.select("QID")))


@query("select 'item_count' as gate, 'stop' as severity, (n <> 180)::bigint as n_violations, case when n <> 180 then n || ' item columns, expected 180' end as sample from (select count(distinct QID) as n from fx_response where response is not null and QID not like '%s1') t")
def item_count_gate(fx):
    """Answered items, counted from answers of which some items have none."""
    blank = F.when(~F.col("QID").like("%s1"), F.col("response"))
    return qa.answered_item_gate(fx.response.withColumn("response", blank), 180)


@query("""select what || '_present' as gate, 'stop' as severity, (n = 0)::bigint as n_violations, case when n = 0 then what || ' is empty' end as sample
 from (select 'selection' as what, count(*) filter (a > 100) as n from fx_params union all select 'bank', count(*) from fx_params) t""")
def rows_gate(fx):
    return qa.rows_gate(fx.params.filter("a > 100"), "selection").unionByName(qa.rows_gate(fx.params, "bank"))


@query("select audit_row, human_final_qid from or_review where human_final_decision in ('accept','revise') and human_final_qid is not null and human_final_qid not in (select QID from fx_bank)")
def unknown_ids(fx):
    return qa.unknown_ids(qa.clean_review(fx.review), fx.bank).select("audit_row", "human_final_qid")


@query("select audit_row, human_final_decision from or_review where human_final_decision in ('accept','revise') and human_final_qid is null")
def approved_without_id(fx):
    return qa.approved_without_id(qa.clean_review(fx.review)).select("audit_row", "human_final_decision")


# ---- plot data -----------------------------------------------------------

def _bin(v: str, lo: str, hi: str, bins: int) -> str:
    return f"(case when {lo} = {hi} then 1 else least(floor(({v} - {lo}) / ({hi} - {lo}) * {bins})::int + 1, {bins}) end)"


@query(f"""with e as (select min(readTime) as lo, max(readTime) as hi from or_numbers),
 c as (select {_bin('readTime', 'lo', 'hi', 30)} as bin, count(*) as n from or_numbers, e where readTime is not null group by 1)
 select b::int as bin, round(lo+(hi-lo)/30*(b-1),6) as bin_lo, round(lo+(hi-lo)/30*b,6) as bin_hi, coalesce(n,0)::bigint as n from range(1,31) r(b) cross join e left join c on c.bin = b""")
def histogram(fx):
    return ds.histogram(respondents(fx), "readTime")


@query("""with q as (select variable, college, quantile_cont(v,0.25) as q1, quantile_cont(v,0.5) as median, quantile_cont(v,0.75) as q3 from
  (select 'transfer' as variable, college, transfer as v from or_numbers union all select 'readTime', college, readTime from or_numbers) z group by 1,2),
 r as (select 'transfer' as variable, college, transfer as v from or_numbers where transfer is not null union all select 'readTime', college, readTime from or_numbers)
 select r.variable, r.college, round(q1,6) as q1, round(median,6) as median, round(q3,6) as q3,
  round(min(v) filter (v between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)),6) as whisker_lo, round(max(v) filter (v between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)),6) as whisker_hi,
  count(*) filter (v not between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)) as n_outliers
 from r join q on r.variable=q.variable and r.college=q.college group by r.variable, r.college, q1, median, q3""")
def box_stats(fx):
    return ds.box_stats(respondents(fx), ["transfer", "readTime"], "college")


@query("select regr_count(theta_2pl, theta_rasch) as n, round(regr_slope(theta_2pl, theta_rasch),6) as slope, round(regr_intercept(theta_2pl, theta_rasch),6) as intercept from fx_scores")
def linear_trend(fx):
    return ds.linear_trend(fx.scores, "theta_rasch", "theta_2pl")


@query("select global_id, round((theta_2pl+theta_bif)/2,6)+0.0 as avg, round(theta_2pl-theta_bif,6)+0.0 as diff, round((select avg(theta_2pl-theta_bif) from fx_scores),6)+0.0 as mean_diff from fx_scores")
def difference_vs_average(fx):
    return ds.difference_vs_average(fx.scores, "theta_2pl", "theta_bif")


@query(f"""with e as (select min(age) as lo, max(age) as hi from or_compare) select {_bin('age', 'lo', 'hi', 10)} as bin, count(*) as n, round(avg(absdiff_2pl_bif),6) as mean_y
 from or_compare, e where age is not null and absdiff_2pl_bif is not null group by 1""")
def binned_trend(fx):
    return ds.binned_trend(compared(fx), "age", "absdiff_2pl_bif", 10)


_SPLINE = ["1.0", "u", "u*u", "u*u*u", *[f"power(greatest(u - {j}/9.0, 0), 3)" for j in range(1, 9)], "y"]


@query("""with d as (select theta_rasch as x, abs(theta_2pl - theta_bif) as y from fx_scores where theta_rasch is not null and theta_2pl is not null), e as (select min(x) as lo, max(x) as hi from d),
 r as (select (x - lo) / (hi - lo) as u, y from d, e) """ + " union all ".join(f"select {i} as i, {j} as j, round(sum({a}*{b}),4)::double as value from r" for i, a in enumerate(_SPLINE) for j, b in enumerate(_SPLINE) if i <= j))
def spline_sums(fx):
    """The normal equations of the smoother, summed over all rows."""
    gaps = fx.scores.select(F.col("theta_rasch").alias("x"), F.abs(F.col("theta_2pl") - F.col("theta_bif")).alias("y"))
    ends = gaps.where("x is not null and y is not null").agg(F.min("x"), F.max("x")).first()
    return smooth.cross_products(gaps, "x", "y", *ends).withColumn("value", F.round("value", 4))


@query()
def smooth_trend(fx):
    """How far two models' scores are apart, over the score: the curve that the plot shows."""
    gaps = fx.scores.withColumn("gap", F.abs(F.col("theta_2pl") - F.col("theta_bif")))
    return smooth.smooth_trend(gaps, "theta_rasch", "gap")


@query(f"""with e as (select min(theta_rasch) as xl, max(theta_rasch) as xh, min(theta_bif) as yl, max(theta_bif) as yh from fx_scores)
 select {_bin('theta_rasch', 'xl', 'xh', 50)} as x_bin, {_bin('theta_bif', 'yl', 'yh', 50)} as y_bin, count(*) as n from fx_scores, e group by 1, 2""")
def bin_2d(fx):
    return ds.bin_2d(fx.scores, "theta_rasch", "theta_bif")


# ---- flows ---------------------------------------------------------------

@query("""select c.global_id, c.source_id, c.cohort, coalesce(c.age, m.age) as age, coalesce(c.gender, m.gender) as gender, c.transfer
 from fx_cohorts c left join fx_cohorts m on m.cohort = 'trial' and m.source_id = c.source_id where c.cohort = 'main'""")
def prepare_flow(fx):
    from respan.plans import flows

    spec = {"global_id": "string", "source_id": "string", "cohort": "string", "age": "int", "gender": "string", "transfer": "string"}
    main, trial = (fx.cohorts.filter(F.col("cohort") == c) for c in ("main", "trial"))
    return flows.prepare_flow(main, trial, spec, ("source_id",), ("age", "gender"), "cohort")


@query("""select 'age' as variable, count(age) as n, round(avg(age),6) as mean, round(quantile_cont(age, 0.5),6) as median from or_numbers
 union all select 'readTime', count(readTime), round(avg(readTime),6), round(quantile_cont(readTime, 0.5),6) from or_numbers""")
def describe_flow(fx):
    from respan.plans import flows

    told = flows.describe_flow(fx.response, respondents(fx), ("college", "gender"), ("age", "readTime"))
    return told.numbers.select("variable", "n", "mean", "median")


@query("""with k as (select r.* from fx_response r join fx_params p using (QID) where p.a >= 1),
 i as (select QID from k group by QID having min(response) < max(response)), l as (select QID, testlet from or_lookup join i using (QID)),
 n as (select count(*)::int as n, (select count(*) from l where testlet in (select testlet from l group by testlet having count(*) >= 2))::int as s,
  (select count(distinct global_id) from k join i using (QID)) as people from i)
 select 'rasch' as model, n as n_items, n + 1 as npar, people as n_respondents, true as best_last from n union all select '2pl', n, 2 * n, people, true from n union all select 'bifactor', n, 2 * n + s, people, true from n""")
def trimmed_comparison_flow(fx):
    """The three models on the items of high slope, without items that all answered alike; a richer model fits no worse."""
    from respan.plans import flows

    kept = fx.params.filter("a >= 1").select("QID")
    done = flows.trimmed_comparison_flow(fx.response, fx.respondent, kept, tol_loglik=1e-6)
    fit = done.comparison.fit
    best = fit.agg(F.max_by("model", "logLik").alias("best"))
    return fit.crossJoin(F.broadcast(best)).select("model", "n_items", "npar", "n_respondents", (F.col("best") == "bifactor").alias("best_last"))
