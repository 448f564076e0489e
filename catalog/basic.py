"""Queries for sources and sinks, projections, filters, joins, order, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import ONE_BYTE
from respan.functions import columns as cf, qid as qf, text as tf
from respan.irt.fit import fit_statistics, factor_map
from respan.lineage import scratch_path
from respan.operators import compare, dedupe, matching, nearstem, quality, rows
from respan.operators.counts import item_counts
from respan.sources import tables as io

TEMPLATE_DDL = "source_name string, question_id string, domainId string, stem string"
NUMERIC = ("age", "transfer", "readTime")


def respondents(fx):
    """Respondents with numeric transfer credits."""
    return fx.respondent.withColumn("transfer", cf.to_double(F.col("transfer")))


# ---- sources and sinks ---------------------------------------------------

@query("select source_name, question_id, nullif(domainId,'') as domainId, nullif(stem,'') as stem from fx_template")
def read_table_csv(fx):
    path = io.write_table(fx.template, scratch_path(fx.spark, "template"), "csv")
    return io.read_table_csv(fx.spark, path, TEMPLATE_DDL)


@query("select stem, domain, QID from fx_bank")
def read_item_bank(fx):
    twice = fx.bank.unionByName(fx.bank.withColumn("stem", F.concat("stem", F.lit("~"))))
    return io.read_item_bank(fx.spark, io.write_table(twice, scratch_path(fx.spark, "bank")))


@query("select global_id, QID, response from fx_response")
def read_responses(fx):
    return io.read_responses(fx.spark, io.write_table(fx.response, scratch_path(fx.spark, "responses")))


@query("select QID, round(a,6) as a, round(b,6)+0.0 as b, g, u from fx_params")
def read_item_params(fx):
    return io.read_item_params(fx.spark, io.write_table(fx.params, scratch_path(fx.spark, "params")))


@query("select stem, QID, domain, null::varchar as question_id from fx_bank union all select stem, null, null, question_id from fx_template")
def read_raw_bundle(fx):
    a = io.write_table(fx.bank, scratch_path(fx.spark, "raw"))
    b = io.write_table(fx.template.select("stem", "question_id"), scratch_path(fx.spark, "raw"))
    return io.read_raw_bundle(fx.spark, [a, b])


@query("select QID, n_responded, round(prop_correct,6) as prop_correct from or_items")
def write_table(fx):
    out = item_counts(fx.response).select("QID", "n_responded", "prop_correct")
    return fx.spark.read.parquet(io.write_table(out, scratch_path(fx.spark, "item_counts")))


@query("select global_id, college, age, nullif(pell,'') as pell, 'csv' as src from (select global_id, college, age, nullif(pell,'NA') as pell from fx_respondent) t union all select global_id, college, age, pell, 'parquet' from fx_respondent")
def save_both(fx):
    out = fx.respondent.select("global_id", "college", "age", "pell")
    pq, csv = io.save_both(out, scratch_path(fx.spark, "both"), "respondents")
    a = fx.spark.read.parquet(pq).withColumn("src", F.lit("parquet"))
    b = io.read_table_csv(fx.spark, csv, "global_id string, college string, age int, pell string")
    return a.unionByName(b.withColumn("src", F.lit("csv")))


@query("select global_id, college, round(theta_rasch,6)+0.0 as theta_rasch, round(theta_2pl,6)+0.0 as theta_2pl from fx_respondent left join fx_scores using (global_id)")
def write_scores(fx):
    scored = compare.attach_scores(
        fx.respondent.select("global_id", "college"), fx.scores.select("global_id", "theta_rasch", "theta_2pl")
    )
    path = io.write_table(scored, scratch_path(fx.spark, "scores"), partition_by=["college"])
    return fx.spark.read.parquet(path).withColumn("college", F.col("college").cast("string"))


@query("select 'item_params' as part, QID as name, round(a,6) as value from fx_params union all select 'fit', model, round(logLik,6) from or_fit union all select 'factor_map', QID, testlet::double from or_lookup")
def write_model(fx):
    from catalog.model import fixed_fit

    fmap = factor_map(fx.params)
    path = io.write_model(fx.params, fixed_fit(fx), scratch_path(fx.spark, "model"), fmap)
    read = fx.spark.read.parquet
    params = read(f"{path}/item_params").select(F.lit("item_params").alias("part"), F.col("QID").alias("name"), F.col("a").alias("value"))
    fit = read(f"{path}/fit").select(F.lit("fit").alias("part"), F.col("model").alias("name"), F.col("logLik").alias("value"))
    maps = read(f"{path}/factor_map").select(
        F.lit("factor_map").alias("part"), F.col("QID").alias("name"), F.col("testlet").cast("double").alias("value")
    )
    return params.unionByName(fit).unionByName(maps)


# ---- projections and filters ---------------------------------------------

@query("select source_id, global_id, college, wave, age, gender, ethnicity, military, pell, transfer, readTime from fx_respondent")
def select_covariates(fx):
    return fx.respondent.select(*compare.COVARIATES)


@query("select distinct QID from fx_response where regexp_matches(QID, '^Q[0-9]{3}')")
def find_item_columns(fx):
    """Long to wide, find the item columns by name, and list them (one row per column)."""
    from catalog.model import item_ids

    wide = rows.to_wide(fx.response, item_ids())
    found = rows.item_columns(wide)
    counted = wide.agg(*[F.count(c).alias(c) for c in found])
    return counted.unpivot([], found, "QID", "n").filter("n > 0").select("QID")


@query("select QID as item, domain as item_domain, stem as item_text from fx_bank")
def project_rename(fx):
    return fx.bank.select(F.col("QID").alias("item"), F.col("domain").alias("item_domain"), F.col("stem").alias("item_text"))


@query("select global_id, readTime, round(readTime/60,6) as read_minutes, readTime < 600 as quick from fx_respondent")
def add_columns(fx):
    t = F.col("readTime")
    return fx.respondent.select("global_id", "readTime").withColumns({"read_minutes": t / 60, "quick": t < 600})


@query("select global_id, try_cast(transfer as int) as transfer, try_cast(pell as int) as pell, age from fx_respondent")
def cast_items(fx):
    return rows.cast_items(fx.respondent.select("global_id", "transfer", "pell", "age"), ["transfer", "pell", "age"])


@query("select global_id, try_cast(transfer as double) as transfer from fx_respondent")
def to_double(fx):
    return respondents(fx).select("global_id", "transfer")


@query("select global_id, age, college from fx_respondent where age in (17,18) and college in ('ua2','ua23')")
def subset(fx):
    return rows.subset(fx.respondent, age=(17, 18), college=("ua2", "ua23")).select("global_id", "age", "college")


@query("select QID, overall_n, domain from or_metrics where overall_n >= 200")
def filter_at_least(fx):
    from catalog.summary import metrics

    return rows.filter_at_least(metrics(fx), "overall_n", 200).select("QID", "overall_n", "domain")


@query("select QID, demographic, group_value, n_responded from or_counts where demographic in ('gender','military')")
def filter_in(fx):
    from catalog.summary import sizes

    return rows.filter_in(sizes(fx), "demographic", ["gender", "military"])


@query("select global_id, pell from fx_respondent where pell is not null and pell not in ('NA','')")
def drop_blank_levels(fx):
    return rows.drop_blank_levels(fx.respondent, "pell").select("global_id", "pell")


@query("select audit_row, human_final_decision, human_final_qid from or_review where human_final_decision = 'reject' or human_final_decision is null or (human_final_decision in ('accept','revise') and human_final_qid is null)")
def unresolved_cases(fx):
    return matching.unresolved_cases(quality.clean_review(fx.review)).select(
        "audit_row", "human_final_decision", "human_final_qid"
    )


@query("select QID, case domain_code when 's' then 1 when 'p' then 2 else 0 end as code_no from or_lookup")
def recode(fx):
    code = qf.recode(qf.domain_code(F.col("QID")), {"s": "1", "p": "2"}, F.lit("0"))
    return fx.params.select("QID", code.cast("int").alias("code_no"))


@query("""select c.source_name, c.question_id, c.current_id, p.approved_QID, coalesce(p.approved_QID, c.current_id) as final_QID,
 case when p.approved_QID is not null then 'llm_human_review' else c.match_method end as final_match_method
 from (select audit_row, source_name, question_id, case when audit_row % 4 = 0 then 'Q999s1' end as current_id, case when audit_row % 4 = 0 then 'fuzzy' end as match_method from or_review) c
 left join or_patches p on c.source_name is not distinct from p.source_name and c.question_id is not distinct from p.question_id""")
def final_id(fx):
    done = matching.final_id(matching.attach_patches(review_cases(fx), patches(fx)))
    return done.select(
        "source_name", "question_id", F.col("QID").alias("current_id"), "approved_QID", "final_QID", "final_match_method"
    )


@query("select source_name, question_id, stem, null::varchar as QID, null::double as string_distance from fx_template")
def project_tolerant(fx):
    spec = {"source_name": "string", "question_id": "string", "stem": "string", "QID": "string", "string_distance": "double"}
    return rows.project_tolerant(fx.template, spec)


@query("select source_name, question_id, null::varchar as llm_suggested_qid, null::varchar as llm_confidence, null::varchar as llm_rationale, null::varchar as human_final_decision, null::varchar as human_final_qid, 'pending' as audit_status from fx_template")
def add_review_shell(fx):
    return matching.add_review_shell(fx.template.select("source_name", "question_id"))


@query("select global_id, case when college like 'ua%' then 'ua' else college end as college from (select global_id, case when age = 21 then null else college end as college from fx_respondent) t where college is distinct from 'umgc1'")
def final_dataset(fx):
    some = fx.respondent.withColumn("college", F.expr("if(age = 21, null, college)"))
    return rows.final_dataset(some).select("global_id", "college")


@query("select global_id, readTime from fx_respondent where readTime >= 300")
def speed_filter(fx):
    return rows.speed_filter(fx.respondent, 300).select("global_id", "readTime")


@query("select global_id, QID, response from fx_response where QID in (select QID from fx_params where a >= 1) and substr(QID,2,3) <> '014'")
def retained_responses(fx):
    """Items of high slope as the bank; the answers to one of them are missing."""
    some = fx.response.withColumn("response", F.when(F.substring("QID", 2, 3) != "014", F.col("response")))
    return rows.retained_responses(some, fx.params.filter("a >= 1"))


# ---- joins ---------------------------------------------------------------

@query("select c.QID, n_responded, testlet, domain from or_items c left join or_lookup using (QID)")
def join_lookup(fx):
    return item_counts(fx.response).select("QID", "n_responded").join(
        qf.item_lookup(fx.response), "QID", "left"
    ).select("QID", "n_responded", "testlet", "domain")


@query("select d.domain, coalesce(n,0)::bigint as n_items from (select unnest(['identifying_details','inference','language_vocabulary','purpose_point_of_view','summary_synthesis']) as domain) d left join (select domain, count(*) as n from or_metrics where min_factor_n >= 20 group by domain) m using (domain)")
def domain_spine(fx):
    from catalog.summary import metrics
    from respan.operators.selection import on_spine

    hits = metrics(fx).filter("min_factor_n >= 20").groupBy("domain").agg(F.count("*").alias("_n"))
    return on_spine(hits, "a").select("domain", F.coalesce("_n", F.lit(0)).cast("long").alias("n_items"))


def review_cases(fx):
    """Review rows as audit cases, some with an id already."""
    has = F.col("audit_row") % 4 == 0
    return fx.review.select(
        "audit_row", "source_name", "question_id",
        F.when(has, "Q999s1").alias("QID"), F.when(has, "fuzzy").alias("match_method"),
    )


def patches(fx):
    return matching.patch_table(quality.clean_review(fx.review), fx.bank)


@query("""select c.audit_row, c.source_name, c.question_id, p.approved_QID, p.approval_source, p.human_final_decision from or_review c
 left join or_patches p on c.source_name is not distinct from p.source_name and c.question_id is not distinct from p.question_id""")
def join_composite(fx):
    cases = fx.review.select("audit_row", "source_name", "question_id")
    return matching.attach_patches(cases, patches(fx))


@query("select audit_row, p.candidates as n_candidates, c.source_name from (select audit_row, count(candidate_QID) as candidates from or_pool group by audit_row) p left join or_cases c using (audit_row)")
def join_row_id(fx):
    cases = numbered_cases(fx)
    pool = matching.candidate_pool(cases, fx.bank)
    n = pool.groupBy("audit_row").agg(F.count("candidate_QID").alias("n_candidates"))
    return n.join(cases.select("audit_row", "source_name"), "audit_row", "left")


def numbered_cases(fx):
    return rows.with_row_id(fx.template, [("source_name", "asc"), ("question_id", "asc")], "audit_row")


@query("select audit_row, source_name, question_id, domainId, source_stem, candidate_rank, candidate_QID, candidate_domain, candidate_stem, round(similarity_jw,6) as similarity_jw, distance_lv from or_pool")
def candidate_pool(fx):
    return matching.candidate_pool(numbered_cases(fx), fx.bank, 5)


@query("select source_id, global_id, college, wave, age, gender, ethnicity, military, pell, transfer, readTime, round(theta_rasch,6)+0.0 as theta_rasch, round(theta_bif,6)+0.0 as theta_bif from fx_respondent left join fx_scores using (global_id)")
def attach_scores(fx):
    s = fx.scores
    return compare.attach_scores(
        fx.respondent.select(*compare.COVARIATES), s.select("global_id", "theta_rasch"), s.select("global_id", "theta_bif")
    )


@query("select 'known' as kind, audit_row, human_final_qid from or_review where human_final_qid in (select QID from fx_bank) union all select 'unknown', audit_row, human_final_qid from or_review where human_final_qid is not null and human_final_qid not in (select QID from fx_bank)")
def valid_ids(fx):
    review = quality.clean_review(fx.review).select("audit_row", "human_final_qid")
    keys = fx.bank.select(F.col("QID").alias("human_final_qid"))
    known = rows.filter_in(review, "human_final_qid", keys).withColumn("kind", F.lit("known"))
    return known.unionByName(rows.filter_not_in(review, "human_final_qid", keys).withColumn("kind", F.lit("unknown")))


MATCH_SQL = """with bankkeys as (select lower(trim(regexp_replace(stem, '\\s+', ' ', 'g'))) as k, d, min(QID) as exact_QID from (select stem, QID, unnest(list_distinct(['', lower(coalesce(domain, ''))])) as d from fx_bank) b group by 1, 2),
staged as (select t.*, b.exact_QID from fx_template t left join bankkeys b on lower(trim(regexp_replace(t.stem, '\\s+', ' ', 'g'))) = b.k and lower(coalesce(t.domainId, '')) = b.d),
pairs as (select s.source_name, s.question_id, b.QID, jaro_similarity({one}s.stem{byte}, {one}b.stem{byte}) as sim, levenshtein({one}s.stem{byte}, {one}b.stem{byte}) as lev
 from staged s join fx_bank b on s.domainId is null or s.domainId = '' or lower(s.domainId) = lower(b.domain) where s.exact_QID is null and s.stem <> ''),
near as (select * from (select *, row_number() over (partition by source_name, question_id order by sim desc, lev, QID) as rn from pairs) z where rn = 1),
fixed as (select source_name, question_id, 'Q001s1' as QID from fx_template where source_name = 'conv_system')
select s.source_name, s.question_id, s.domainId, s.stem, coalesce(s.exact_QID, case when 1 - n.sim <= 0.35 then n.QID end, f.QID) as QID,
 case when s.exact_QID is not null then 'exact' when 1 - n.sim <= 0.35 then 'fuzzy' when f.QID is not null then 'manual_repair' end as match_method,
 case when s.exact_QID is null and 1 - n.sim <= 0.35 then round(1 - n.sim, 6) end as string_distance
from staged s left join near n using (source_name, question_id) left join fixed f using (source_name, question_id)""".replace("{one}", ONE_BYTE[0]).replace("{byte}", ONE_BYTE[1])


@query(MATCH_SQL)
def match_items(fx):
    repairs = fx.template.filter("source_name = 'conv_system'").select("source_name", "question_id", F.lit("Q001s1").alias("QID"))
    return matching.match_items(fx.template, fx.bank, repairs, 0.35)


_PROBES = "select distinct nullif(lower(domainId),'') as domain_key, lower(stem) as stem_key from fx_template where stem <> ''"


def stem_probes(fx):
    return fx.template.select(F.nullif(F.lower("domainId"), F.lit("")).alias("domain_key"), F.lower("stem").alias("stem_key")).where("stem_key <> ''")


@query(f"""select domain_key, stem_key, QID as candidate_QID, round(sim,6) as similarity_jw from (
 select domain_key, stem_key, b.QID, jaro_similarity({{one}}stem_key{{byte}}, {{one}}b.stem{{byte}}) as sim from ({_PROBES}) p join fx_bank b on domain_key is null or domain_key = lower(b.domain)) z
 where sim >= 0.8""".replace("{one}", ONE_BYTE[0]).replace("{byte}", ONE_BYTE[1]))
def similar_stems(fx):
    """Every bank item of a similarity of 0.8 or more: the threshold join below the fuzzy stage."""
    found = nearstem.similar_stems(stem_probes(fx), fx.bank, 0.8)
    return found.select("domain_key", "stem_key", "candidate_QID", "similarity_jw")


_CLASSES = "list_transform(range(32), lambda k: len(list_filter(string_split({0}, ''), lambda x: unicode(x) % 32 = k)))"


@query(f"""with p as (select *, {_CLASSES.format('stem_key')} as c, length(stem_key) as a from ({_PROBES}) z),
 b as (select QID, lower(domain) as d, {_CLASSES.format('lower(stem)')} as c, length(stem) as n from fx_bank),
 m as (select domain_key, stem_key, a, n, list_sum(list_transform(list_zip(p.c, b.c), lambda z: least(z[1], z[2]))) as s from p join b on domain_key is null or domain_key = d)
 select domain_key, stem_key, count(*) as n_domain, count(*) filter (s > 0 and (s / a + s / n + 1) / 3 >= 0.8 - 1e-9) as n_possible from m group by all""")
def stem_bounds(fx):
    """How many bank items of its domain each stem is compared with, of those there are."""
    return nearstem.stem_bounds(stem_probes(fx), fx.bank, 0.8)


@query(f"""select source_name, question_id, QID, string_distance, case when match_method is null then 'unmatched_after_exact_fuzzy'
  when match_method = 'fuzzy' then 'high_distance_fuzzy_match' else 'manual_repair_secondary_check' end as audit_reason from ( {MATCH_SQL} ) m
 where match_method is null or match_method = 'manual_repair' or match_method = 'fuzzy' and string_distance >= 0.08""")
def cases_after_matching(fx):
    """Staged identity, its three outputs, and the cases to audit."""
    repairs = fx.template.filter("source_name = 'conv_system'").select("source_name", "question_id", F.lit("Q001s1").alias("QID"))
    unmatched, fuzzy, manual = matching.staged_outputs(matching.match_items(fx.template, fx.bank, repairs, 0.35))
    return matching.audit_cases(unmatched, fuzzy, manual).select("source_name", "question_id", "QID", "string_distance", "audit_reason")


@query("select a.global_id as survivor_id, b.global_id as matched_id, a.cohort as survivor_cohort, b.cohort as matched_cohort from fx_cohorts a join fx_cohorts b on a.source_id = b.source_id and a.cohort = 'main' and b.cohort = 'trial'")
def duplicate_pairs(fx):
    unknown = fx.cohorts.filter("cohort = 'main'").select(F.concat(F.lit("N"), "global_id").alias("global_id"), "source_id", F.lit(None).cast("string").alias("cohort"))
    return dedupe.duplicate_pairs(fx.cohorts.select("global_id", "source_id", "cohort").unionByName(unknown), ["source_id"], "cohort")


@query("select c.global_id, c.source_id, c.cohort, coalesce(c.age, m.age) as age, coalesce(c.gender, m.gender) as gender, c.transfer from fx_cohorts c left join fx_cohorts m on c.cohort = 'main' and m.cohort = 'trial' and m.source_id = c.source_id")
def patch_rows(fx):
    pairs = dedupe.duplicate_pairs(fx.cohorts, ["source_id"], "cohort")
    return dedupe.patch_rows(fx.cohorts, pairs, ["age", "gender"])


@query("select global_id, cohort from fx_cohorts where cohort = 'main'")
def remove_rows(fx):
    pairs = dedupe.duplicate_pairs(fx.cohorts, ["source_id"], "cohort")
    drops = pairs.select(F.col("matched_id").alias("global_id"))
    return dedupe.remove_rows(fx.cohorts, drops).select("global_id", "cohort")


@query("select global_id, QID, response from fx_response where QID in (select QID from fx_params where a >= 1)")
def restrict_items(fx):
    return rows.restrict_items(fx.response, fx.params.filter("a >= 1"))


# ---- windows -------------------------------------------------------------

@query("select audit_row, candidate_rank, candidate_QID from or_pool")
def candidate_rank(fx):
    return matching.candidate_pool(numbered_cases(fx), fx.bank, 5).select("audit_row", "candidate_rank", "candidate_QID")


@query("select audit_row, source_name, question_id from or_cases")
def with_row_id(fx):
    return numbered_cases(fx).select("audit_row", "source_name", "question_id")


@query("select audit_row, candidate_QID, round(similarity_jw,6) as similarity_jw from or_pool where candidate_rank <= 2 or candidate_rank is null")
def top_k_per_case(fx):
    return matching.candidate_pool(numbered_cases(fx), fx.bank, 2).select("audit_row", "candidate_QID", "similarity_jw")


@query("select 'college' as variable, college as category, round(100.0*count(*)/sum(count(*)) over (),6) as percent from fx_respondent group by college union all select 'pell', pell, round(100.0*count(*)/sum(count(*)) over (),6) from fx_respondent group by pell")
def share_of_total(fx):
    from respan.operators.describe import categorical_descriptives

    return categorical_descriptives(fx.respondent, ["college", "pell"]).select("variable", "category", "percent")


@query("select l.testlet::int as testlet, dense_rank() over (order by l.testlet::int)::int as factor, QID from or_lookup l")
def number_factors(fx):
    return factor_map(fx.params).select("testlet", "factor", "QID")


_FIT_SQL = "(select *, -2*logLik+2*npar as aic, -2*logLik+npar*ln(n_respondents) as bic from or_fit)"


@query(f"select model, 'AIC' as criterion, row_number() over (order by aic, model)::int as model_rank from {_FIT_SQL} x union all select model, 'BIC', row_number() over (order by bic, model)::int from {_FIT_SQL} y union all select model, 'BIC_AIC', row_number() over (order by bic, aic, model)::int from {_FIT_SQL} z")
def rank_models(fx):
    from catalog.model import fixed_fit

    fit = fit_statistics(fixed_fit(fx))
    ranked = [
        compare.rank_models(fit, *by).select("model", F.lit("_".join(by)).alias("criterion"), "model_rank")
        for by in (("AIC",), ("BIC",), ("BIC", "AIC"))
    ]
    return rows.stack(*ranked)


@query("select * exclude (rn) from (select source_name, question_id, audit_row, row_number() over (partition by source_name, question_id order by audit_row) as rn from fx_review) t where rn = 1")
def first_per_key(fx):
    return rows.distinct_first(
        fx.review.select("source_name", "question_id", "audit_row"), ["source_name", "question_id"], [("audit_row", "asc")]
    )


@query("select QID, rn::int as item_index, ((rn+5)//6)::int as testlet from (select QID, row_number() over (order by QID) as rn from or_lookup) t")
def testlet_blocks(fx):
    return rows.testlet_blocks(fx.response)


@query("select user_id, count(ts) as n_rows, round((epoch_us(max(ts))-epoch_us(min(ts)))/1e6,6) as elapsed_seconds, round((epoch_us(max(ts))-epoch_us(min(ts)))/1e6/nullif(count(ts)-1,0),6) as mean_step_seconds from events group by user_id")
def student_timing(fx):
    return dedupe.student_timing(fx.events, "user_id", "ts")


@query("""with e as (select event_id, case when event_id % 41 = 0 then null else user_id end as user_id, case when event_id % 37 = 0 then null else ts end as ts from events)
select event_id, user_id, round((epoch_us(ts)-epoch_us(lag(ts) over (partition by user_id order by ts)))/1e6,6) as step_seconds from e where user_id is not null and ts is not null
union all select event_id, user_id, null from e where user_id is null or ts is null""")
def item_timing(fx):
    events = fx.events.select(
        "event_id", F.expr("if(event_id % 41 = 0, null, user_id)").alias("user_id"), F.expr("if(event_id % 37 = 0, null, ts)").alias("ts")
    )
    timed = dedupe.item_timing(events, "user_id", "ts")
    return timed.select("event_id", "user_id", "step_seconds")


@query("select user_id, event_type, round(value,6) as value, event_id from (select *, row_number() over (partition by user_id, cast(ts as date), event_type order by ts, event_id) as rn from events) t where rn = 1")
def dedupe_completion(fx):
    events = fx.events.withColumn("completion", F.to_date("ts"))
    kept = dedupe.dedupe_completion(events, ["user_id", "completion", "event_type"], [("ts", "asc"), ("event_id", "asc")])
    return kept.select("user_id", "event_type", "value", "event_id")


# ---- sort, limit ---------------------------------------------------------

@query("select QID, n_flags, round(a,6) as a, round(b,6)+0.0 as b from or_flags order by n_flags desc nulls last, a asc nulls last, QID")
def sort_rows(fx):
    from catalog.model import diagnostics

    return rows.sort_rows(diagnostics(fx), [("n_flags", "desc"), ("a", "asc"), ("QID", "asc")]).select("QID", "n_flags", "a", "b")


@query("select QID, n_responded from or_items order by QID")
def sort_one_key(fx):
    return item_counts(fx.response).select("QID", "n_responded").orderBy("QID")


@query("select testlet, count(*) as n_items from or_lookup group by testlet order by testlet::int")
def sort_numeric_text(fx):
    per = qf.item_lookup(fx.response).groupBy("testlet").agg(F.count("*").alias("n_items"))
    return rows.sort_numeric_text(per, "testlet")


@query("select QID, n_responded from or_items order by n_responded desc, QID limit 30")
def head_rows(fx):
    return rows.head_rows(item_counts(fx.response), [("n_responded", "desc"), ("QID", "asc")], 30).select("QID", "n_responded")


@query("select QID, n_flags, trim_candidate from or_flags order by trim_candidate desc, n_flags desc, a, abs(b) desc, QID limit 30")
def worst_items(fx):
    from catalog.model import diagnostics
    from respan.operators.trim import worst_items as worst

    return worst(diagnostics(fx), 30).select("QID", "n_flags", "trim_candidate")


# ---- sets ----------------------------------------------------------------

@query("select QID, domain, stem, null::varchar as source_name from fx_bank union all select null, null, stem, source_name from fx_template")
def stack(fx):
    return rows.stack(fx.bank, fx.template.select("stem", "source_name"))


@query("select QID from or_flags where trim_candidate")
def item_difference(fx):
    from catalog.model import diagnostics

    return rows.item_difference(fx.params, diagnostics(fx).filter("not trim_candidate"))


@query("select distinct ethnicity from fx_respondent")
def distinct_values(fx):
    return rows.distinct_values(fx.respondent, "ethnicity")


@query("select global_id, wave, age::double as age, try_cast(transfer as double) as transfer, case when wave='2022' then null else pell end as pell from fx_respondent")
def stack_waves(fx):
    spec = {"global_id": "string", "wave": "string", "age": "double", "transfer": "double", "pell": "string"}
    a = fx.respondent.filter("wave = '2022'").drop("pell")
    b = fx.respondent.filter("wave <> '2022'")
    return rows.stack_waves(a, b, spec)


# ---- scalar functions ----------------------------------------------------

@query("select QID, domain_code from or_lookup")
def domain_code_strict(fx):
    return qf.item_lookup(fx.response).select("QID", "domain_code")


@query("select QID, lower(regexp_replace(regexp_replace(QID,'^Q[0-9]{3}',''),'[0-9]+$','')) as domain_code from (select QID from or_lookup union all select domain_code from or_lookup) t")
def domain_code_lenient(fx):
    lookup = qf.item_lookup(fx.response)
    both = lookup.select("QID").union(lookup.select("domain_code"))
    return both.select("QID", qf.domain_code(F.col("QID"), strict=False).alias("domain_code"))


@query("select QID, testlet from or_lookup")
def testlet_of_item(fx):
    return fx.params.select("QID", qf.testlet(F.col("QID")).alias("testlet"))


@query("select QID, domain_a as label_a, domain as label_b from or_lookup")
def domain_labels(fx):
    code = qf.domain_code(F.col("QID"))
    return fx.params.select("QID", qf.domain_label(code, "a").alias("label_a"), qf.domain_label(code, "b").alias("label_b"))


@query("select source_name, question_id, nullif(lower(trim(domainId)),'') as domainId, nullif(lower(trim(stem)),'') as stem from fx_template")
def clean_text(fx):
    return rows.clean_columns(fx.template, ["domainId", "stem"])


@query("select source_name, question_id, coalesce(source_name,'NA')||'/'||coalesce(question_id,'NA')||' ['||coalesce(domainId,'NA')||']: '||coalesce(stem,'NA') as line from fx_template")
def paste_cols(fx):
    c = F.col
    line = cf.paste_cols(c("source_name"), F.lit("/"), c("question_id"), F.lit(" ["), c("domainId"), F.lit("]: "), c("stem"))
    return fx.template.select("source_name", "question_id", line.alias("line"))


@query("select p_partkey, round(jaro_similarity(lower(p_name), lower(p_type)),6) as similarity from part")
def jaro_similarity(fx):
    return fx.part.select("p_partkey", tf.jaro_similarity(F.lower("p_name"), F.lower("p_type")).alias("similarity"))


@query("select p_partkey, levenshtein(lower(p_name), lower(p_type)) as distance from part")
def edit_distance(fx):
    return fx.part.select("p_partkey", tf.edit_distance(F.lower("p_name"), F.lower("p_type")).alias("distance"))


@query("select global_id, round(theta_rasch-theta_bif,6)+0.0 as diff, round(abs(theta_rasch-theta_bif),6) as absdiff, round((theta_rasch+theta_bif)/2,6)+0.0 as avg from fx_scores")
def pair_difference(fx):
    cols = cf.pair_difference(F.col("theta_rasch"), F.col("theta_bif"))
    return fx.scores.select("global_id", *[c.alias(n) for n, c in cols.items()])


@query("select QID, n_flags, n_flags > 0 as any_flag from or_flags")
def count_flags(fx):
    from catalog.model import diagnostics
    from respan.operators.trim import FLAGS

    n = cf.count_flags(*[F.col(f) for f in FLAGS])
    return diagnostics(fx).select("QID", n.alias("n_flags"), (n > 0).alias("any_flag"))


@query("select global_id, coalesce(age < 18 or age > 40, false) as unusual_age, coalesce(try_cast(transfer as double) > 80, false) as many_credits from fx_respondent")
def range_flag(fx):
    return respondents(fx).select(
        "global_id",
        cf.range_flag(F.col("age"), lo=18, hi=40).alias("unusual_age"),
        cf.range_flag(F.col("transfer"), hi=80).alias("many_credits"),
    )


@query("select global_id, case when age < 24 then 'TCAUS' when age >= 24 then 'AUS' end as age_d24 from fx_respondent")
def age_group(fx):
    return fx.respondent.select("global_id", qf.age_group(F.col("age")).alias("age_d24"))


@query("select global_id, ethnicity, case when pell = 'Yes' then 'Yes' when pell = 'No' then 'No' end as pell, military from fx_respondent")
def recode_covariates(fx):
    return fx.respondent.select(
        "global_id", qf.recode_ethnicity(F.upper("ethnicity")).alias("ethnicity"),
        qf.recode_yes_no(F.col("pell")).alias("pell"), qf.recode_yes_no(F.lower("military")).alias("military"),
    )


@query("select source_id, upper(regexp_replace(trim(source_id),'[^0-9A-Za-z]','','g')) as clean_id, college||'_'||upper(regexp_replace(trim(source_id),'[^0-9A-Za-z]','','g')) as new_id from fx_respondent")
def normalize_id(fx):
    s = F.col("source_id")
    return fx.respondent.select(
        "source_id", qf.normalize_id(s).alias("clean_id"), qf.global_id(F.col("college"), s).alias("new_id")
    )


@query("select r.global_id, coalesce(l.QID, r.QID) as QID, r.response, l.QID is not null as qid_mapped from fx_response r left join fx_legacy l on r.QID = l.legacy_QID")
def harmonize_qid(fx):
    twice = fx.legacy.unionByName(fx.legacy.withColumn("QID", F.concat("QID", F.lit("y"))))
    return qf.harmonize_qid(fx.response, twice)
