"""Assessment-shaped views over the given tables; the text runs in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from respan.lineage import cut_lineage

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

_DOMAIN = "case {k} % 5 when 0 then 'structure' when 1 then 'inference' when 2 then 'ideas' when 3 then 'purpose' else 'language' end"
_CODE = "case {k} % 5 when 0 then 's' when 1 then 'in' when 2 then 'id' when 3 then 'p' else 'l' end"
# DuckDB's distances count bytes: there, and only there, each lower-case character outside ASCII that the
# texts hold is put as a control character they do not hold, so that both engines count characters.
_WIDE = "ßäçèéêíñóöü"
ONE_BYTE = ("translate(lower(", f"), '{_WIDE}', " + " || ".join(f"chr({i})" for i in (*range(1, 9), *range(14, 14 + len(_WIDE) - 8))) + ")")
_UPPER = "translate({c}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"  # the engines differ on other letters


def view_sql(engine: str) -> dict[str, str]:
    """View name -> SQL.  Later views may use earlier ones."""
    text = "text"
    return {
        "fx_respondent": """
select concat('G',lpad(cast(c_custkey as string),6,'0')) as global_id, concat(' s-',cast(c_custkey as string),' ') as source_id,
 case c_custkey % 4 when 0 then 'ua2' when 1 then 'ua23' when 2 then 'umgc' else 'umgc1' end as college,
 case when c_custkey % 4 in (0,3) then '2022' else '2022-2023' end as wave,
 case when c_custkey % 23 = 0 then null else cast(17 + c_custkey % 30 as int) end as age,
 case when c_custkey % 17 = 0 then null when c_nationkey % 2 = 0 then 'F' else 'M' end as gender,
 case c_mktsegment when 'AUTOMOBILE' then 'White' when 'BUILDING' then 'Asian' when 'FURNITURE' then 'Black' when 'HOUSEHOLD' then 'Hispanic' else 'Other' end as ethnicity,
 case when c_nationkey % 5 = 0 then 'Yes' else 'No' end as military,
 case when c_custkey % 19 = 0 then 'NA' when c_custkey % 31 = 0 then '' when c_custkey % 3 = 0 then 'Yes' else 'No' end as pell,
 case when c_custkey % 13 = 0 then 'n/a' else cast(c_custkey % 91 as string) end as transfer,
 cast(60 + (c_custkey * 37) % 1800 as double) as readTime from customer""",
        "fx_response": f"""
select concat('G',lpad(cast(sid as string),6,'0')) as global_id,
 concat('Q',lpad(cast(k as string),3,'0'),{_CODE.format(k='k')},cast(tl as string)) as QID,
 case when min(u) < 1.0e0/(1.0e0+exp(-(0.6e0+((k-1)%7)*0.2e0)*(min(theta)+min(eff)-(((k-1)*37%180)/60.0e0-1.5e0)))) then 1 else 0 end as response
from (select sid, tl, (tl-1)*6+1+slot as k, u, theta,
  1.2e0*(2.0e0*((sid*tl*7919+sid*31+tl*1013)%1009)/1008.0e0-1.0e0) as eff
 from (select o_custkey as sid,
   case when l_partkey % 10 < 3 then 1+l_partkey%3 else 4+(o_custkey*7+l_partkey%9)%27 end as tl,
   (l_suppkey*5+l_orderkey)%6 as slot,
   ((l_orderkey*7919+l_linenumber*104729+l_partkey*1299709)%10007)/10007.0e0 as u,
   (c_acctbal-4500.0e0)/3200.0e0 as theta
  from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey) x) y
group by sid, tl, k""",
        "fx_bank": f"""
select concat('Q',lpad(cast(item_id+1 as string),3,'0'),{_CODE.format(k='item_id')},cast(cast(floor((item_id+6)/6.0) as int) as string)) as QID,
 {_DOMAIN.format(k='item_id')} as domain, {text} as stem from benchmark""",
        # uncertain items: every conversation text, an edited copy and a re-cased copy of each bank stem
        "fx_template": f"""
select concat('conv_', role) as source_name, concat(cast(conv_id as string),'.',cast(turn as string)) as question_id,
 case when conv_id % 7 = 0 then null when conv_id % 7 = 1 then '' else {_DOMAIN.format(k='(conv_id + turn)')} end as domainId,
 case when conv_id % 29 = 3 then null else {text} end as stem from conversations
 union all select 'edited', concat('b',cast(item_id as string)), upper({_DOMAIN.format(k='item_id')}), lower(substr({text},3)) from benchmark
 union all select 'recased', concat('b',cast(item_id as string)), {_DOMAIN.format(k='item_id')}, concat('  ', {_UPPER.format(c=text)}) from benchmark""",
        # true item parameters of fx_response
        "fx_params": """
select QID, cast(3 + (k-1) % 7 as double) / 5 as a, cast((k-1)*37 % 180 - 90 as double) / 60 as b, cast(0 as double) as g, cast(1 as double) as u
 from (select distinct QID, cast(substr(QID,2,3) as int) as k from fx_response) z""",
        # three score columns per respondent with some missing
        "fx_scores": """
select concat('G',lpad(cast(c_custkey as string),6,'0')) as global_id,
 (c_acctbal-4500)/3217 as theta_rasch,
 case when c_custkey % 29 = 5 then null else 9*(c_acctbal-4500)/32009 + cast((c_custkey*37)%101 as double)/503 end as theta_2pl,
 (c_acctbal-4500)/4003 - cast((c_custkey*53)%97 as double)/401 as theta_bif from customer""",
        # a completed review: all decisions, unknown and missing ids, repeated cases
        "fx_review": f"""
select doc_id as audit_row, source as source_name, concat('q', cast(n_chars % 500 as string)) as question_id,
 case when doc_id % 11 = 0 then null else {_DOMAIN.format(k='doc_id')} end as domainId, concat(lang, ' ', source) as source_stem,
 case when doc_id % 9 = 0 then '' when doc_id % 9 = 1 then null
  else concat(' Q', lpad(cast(doc_id % 45 + 1 as string),3,'0'), {_CODE.format(k='(doc_id % 45)')}, cast(cast(floor((doc_id % 45 + 6)/6.0) as int) as string)) end as human_final_qid,
 case doc_id % 5 when 0 then 'accept' when 1 then ' Reject ' when 2 then 'REVISE' when 3 then null else 'Accept' end as human_final_decision,
 'done ' as audit_status from documents""",
        # two cohorts: every respondent, and copies of the umgc ones with some blanks filled
        "fx_cohorts": """
select global_id, trim(source_id) as source_id, 'main' as cohort, age, gender, transfer from fx_respondent
 union all select concat('T',substr(global_id,2)), trim(source_id), 'trial', coalesce(age,99), coalesce(gender,'U'), transfer from fx_respondent where college = 'umgc'""",
        # every answer twice, under the main and the trial id
        "fx_double_response": """
select global_id, QID, response from fx_response
 union all select concat('T',substr(global_id,2)), QID, response from fx_response""",
        # every respondent a second time, with some answers changed and some left out
        "fx_retest": """
select global_id, QID, response from fx_response
 union all select concat('T',substr(global_id,2)), QID, case when (cast(substr(global_id,2) as int) + cast(substr(QID,2,3) as int)) % 31 = 0 then 1 - response else response end
 from fx_response where (cast(substr(global_id,2) as int) * 7 + cast(substr(QID,2,3) as int)) % 41 <> 0""",
        # legacy ids of half the items
        "fx_legacy": """
select QID as legacy_QID, concat(QID,'x') as QID from fx_params where a > 1.2""",
    }


# The same rows for Spark at scale: narrow columns are made below the shuffles, what a respondent's answers share is joined last,
# so that the rows lie as they are grouped, and the items are listed without the answers.
_TAKEN = """
select sid, coalesce(fixed, 4+(sid*7+p9)%27) as tl, slot, u from (
 select o_custkey as sid, fixed, p9, slot, u from (
  select l_orderkey, case when l_partkey % 10 < 3 then 1+l_partkey%3 end as fixed, l_partkey%9 as p9, (l_suppkey*5+l_orderkey)%6 as slot,
   ((l_orderkey*7919+l_linenumber*104729+l_partkey*1299709)%10007)/10007.0e0 as u from lineitem) l join orders on l_orderkey=o_orderkey) x"""
_QID = f"concat('Q',lpad(cast(k as string),3,'0'),{_CODE.format(k='k')},cast(tl as string))"
_SPARK_SQL = {
    "fx_response": f"""
select concat('G',lpad(cast(sid as string),6,'0')) as global_id, {_QID} as QID,
 case when u < 1.0e0/(1.0e0+exp(-(0.6e0+((k-1)%7)*0.2e0)*(theta+1.2e0*(2.0e0*((sid*tl*7919+sid*31+tl*1013)%1009)/1008.0e0-1.0e0)-(((k-1)*37%180)/60.0e0-1.5e0)))) then 1 else 0 end as response
from (select sid, tl, k, min(u) as u, min(theta) as theta from (
 select sid, tl, (tl-1)*6+1+slot as k, u, theta from ({_TAKEN}) t join (select c_custkey, (c_acctbal-4500.0e0)/3200.0e0 as theta from customer) c on sid=c_custkey) y
 group by sid, tl, k) z""",
    "fx_params": f"""
select QID, cast(3 + (k-1) % 7 as double) / 5 as a, cast((k-1)*37 % 180 - 90 as double) / 60 as b, cast(0 as double) as g, cast(1 as double) as u
 from (select QID, cast(substr(QID,2,3) as int) as k from (select distinct {_QID} as QID from (
  select distinct tl, (tl-1)*6+1+slot as k from ({_TAKEN}) t left semi join customer on sid=c_custkey) i) q) z""",
}
_ITEM_SIZED = ("fx_params",)  # read by many steps of a query: made once

_VIEW_SQL = view_sql("spark") | _SPARK_SQL
_OPENED: dict[tuple[str, str, str], DataFrame] = {}


class Fixtures:
    """The given tables and the views as DataFrames, opened when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self._open(name)
        if f"fx_{name}" in _VIEW_SQL:
            return self._open(f"fx_{name}")
        raise AttributeError(name)

    def _open(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _OPENED:
            if name in TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                sql = _VIEW_SQL[name]
                for used in (*TABLES, *_VIEW_SQL):
                    if used != name and _uses(sql, used):
                        self._open(used).createOrReplaceTempView(used)
                df = self.spark.sql(sql)
                if name in _ITEM_SIZED:
                    df = cut_lineage(df)
            _OPENED[key] = df
        return _OPENED[key]


# Views only the oracle needs: results of one operator that feed another one's SQL.
ORACLE_VIEWS = {
    "or_counts": " union all ".join(
        f"select QID, '{d}' as demographic, {d} as group_value, count(*) as n_responded "
        "from fx_response join fx_respondent using (global_id) group by all"
        for d in ("college", "wave", "gender", "ethnicity", "military", "pell")
    ),
    "or_items": """select QID, count(response) as n_responded, sum(case when response=0 then 1 else 0 end) as n_wrong,
 sum(case when response=1 then 1 else 0 end) as n_correct, avg(case when response=1 then 1.0 else 0.0 end) as prop_correct,
 avg(case when response=0 then 1.0 else 0.0 end) as prop_wrong from fx_response group by QID""",
    "or_lookup": """select QID, nullif(regexp_extract(QID,'[0-9]+$'),'') as testlet, nullif(regexp_extract(QID,'^Q[0-9]{3}([A-Za-z]+)[0-9]+$',1),'') as domain_code,
 case regexp_extract(QID,'^Q[0-9]{3}([A-Za-z]+)[0-9]+$',1) when 's' then 'structure' when 'in' then 'inference' when 'id' then 'ideas' when 'p' then 'purpose' when 'l' then 'language' end as domain,
 case regexp_extract(QID,'^Q[0-9]{3}([A-Za-z]+)[0-9]+$',1) when 's' then 'summary_synthesis' when 'in' then 'inference' when 'id' then 'identifying_details' when 'p' then 'purpose_point_of_view' when 'l' then 'language_vocabulary' end as domain_a
 from (select distinct QID from fx_response) q""",
    "or_metrics": """select l.QID, l.domain_a as domain, o.overall_n, g.min_dif_n, f.min_factor_n from or_lookup l
 left join (select QID, max(n) as overall_n from (select QID, demographic, sum(n_responded)::bigint as n from or_counts group by all) t group by QID) o using (QID)
 left join (select QID, min(n_responded) as min_dif_n from or_counts where demographic in ('gender','military') and group_value is not null and group_value not in ('NA','') group by QID) g using (QID)
 left join (select QID, min(n_responded) as min_factor_n from or_counts where group_value is not null and group_value not in ('NA','') group by QID) f using (QID)""",
    "or_diag": """select l.QID, l.testlet, l.domain_code, l.domain, c.n_responded, c.prop_correct, p.a, p.b,
 coalesce(p.a < 0.8, false) as flag_low_a, coalesce(p.a > 1.7, false) as flag_high_a, coalesce(p.b < -1.4 or p.b > 1.4, false) as flag_extreme_b,
 coalesce(c.n_responded < 200, false) as flag_low_n, coalesce(c.prop_correct < 0.3 or c.prop_correct > 0.8, false) as flag_poor_p
 from or_lookup l left join or_items c using (QID) left join fx_params p using (QID)""",
    "or_flags": """select *, flag_low_a::int + flag_high_a::int + flag_extreme_b::int + flag_low_n::int + flag_poor_p::int as n_flags,
 (flag_low_a or flag_high_a or flag_extreme_b or flag_low_n or flag_poor_p) as trim_candidate from or_diag""",
    "or_cases": """select row_number() over (order by source_name, question_id) as audit_row, * from fx_template""",
    "or_pool": """select * from (select c.audit_row, c.source_name, c.question_id, c.domainId, c.stem as source_stem,
  case when b.QID is not null then row_number() over (partition by c.audit_row order by jaro_similarity({one}nullif(c.stem,''){byte}, {one}b.stem{byte}) desc nulls last, levenshtein({one}nullif(c.stem,''){byte}, {one}b.stem{byte}) asc nulls last, b.QID) end as candidate_rank,
  b.QID as candidate_QID, b.domain as candidate_domain, b.stem as candidate_stem,
  jaro_similarity({one}nullif(c.stem,''){byte}, {one}b.stem{byte}) as similarity_jw, levenshtein({one}nullif(c.stem,''){byte}, {one}b.stem{byte}) as distance_lv
 from or_cases c left join fx_bank b on c.domainId is null or c.domainId = '' or lower(c.domainId) = lower(b.domain)) x
 where candidate_rank <= 5 or candidate_rank is null""",
    "or_review": """select * exclude (human_final_qid, human_final_decision, audit_status), nullif(trim(human_final_qid),'') as human_final_qid,
 nullif(lower(trim(human_final_decision)),'') as human_final_decision, trim(audit_status) as audit_status from fx_review""",
    "or_patches": """select source_name, question_id, domainId, source_stem as stem, human_final_qid as approved_QID, 'llm_human_review' as approval_source, human_final_decision
 from (select *, row_number() over (partition by source_name, question_id order by audit_row) as rn from or_review
  where human_final_decision in ('accept','revise') and human_final_qid in (select QID from fx_bank)) t where rn = 1""",
    "or_numbers": """select * exclude (transfer), try_cast(transfer as double) as transfer from fx_respondent""",
    "or_compare": """select *, theta_rasch-theta_2pl as diff_rasch_2pl, abs(theta_rasch-theta_2pl) as absdiff_rasch_2pl, (theta_rasch+theta_2pl)/2 as avg_rasch_2pl,
 theta_rasch-theta_bif as diff_rasch_bif, abs(theta_rasch-theta_bif) as absdiff_rasch_bif, (theta_rasch+theta_bif)/2 as avg_rasch_bif,
 theta_2pl-theta_bif as diff_2pl_bif, abs(theta_2pl-theta_bif) as absdiff_2pl_bif, (theta_2pl+theta_bif)/2 as avg_2pl_bif
 from or_numbers left join fx_scores using (global_id)""",
    "or_nodes": """select i as node, -6 + 0.2*i as theta, -0.5*power(-6+0.2*i,2) - ln(sum(exp(-0.5*power(-6+0.2*i,2))) over ()) as lw from range(61) t(i)""",
    "or_ll": """select r.global_id, n.node, any_value(n.theta) as theta, any_value(n.lw) + sum(case when response=1 then -ln(1+exp(-p.a*(n.theta-p.b))) else -ln(1+exp(p.a*(n.theta-p.b))) end) as l
 from fx_response r join fx_params p using (QID) cross join or_nodes n group by r.global_id, n.node""",
    "or_post": """select global_id, node, theta, exp(l - m) / sum(exp(l - m)) over (partition by global_id) as w, m + ln(sum(exp(l - m)) over (partition by global_id)) as lm
 from (select *, max(l) over (partition by global_id) as m from or_ll) t""",
    "or_ll_rasch": """select r.global_id, n.node, any_value(n.theta) as theta, any_value(n.lw) + sum(case when response=1 then -ln(1+exp(-(n.theta-p.b))) else -ln(1+exp(n.theta-p.b)) end) as l
 from fx_response r join fx_params p using (QID) cross join or_nodes n group by r.global_id, n.node""",
    "or_fit": """select 'rasch' as model, 180 as n_items, 181 as npar, count(*) as n_respondents, sum(lm) as logLik from (select global_id, max(l) + ln(sum(exp(l - m))) as lm from (select *, max(l) over (partition by global_id) as m from or_ll_rasch) t group by global_id) u
 union all select '2pl', 180, 360, count(*), sum(lm) from (select global_id, any_value(lm) as lm from or_post group by global_id) v""",
}


def with_views(sql: str, *names: str) -> str:
    """Oracle text: the named views (and those they use) as common table expressions."""
    all_views = {**view_sql("duckdb"), **ORACLE_VIEWS}
    all_views["or_pool"] = all_views["or_pool"].replace("{one}", ONE_BYTE[0]).replace("{byte}", ONE_BYTE[1])
    needed = set(names) | {v for v in all_views if v in sql.replace(",", " ").replace("(", " ").replace(")", " ").split()}
    for name in reversed(list(all_views)):
        if name in needed:
            needed |= {o for o in all_views if o != name and _uses(all_views[name], o)}
    parts = [f"{n} as ({all_views[n]})" for n in all_views if n in needed]
    body = sql.strip()
    if not parts:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


def _uses(text: str, view: str) -> bool:
    return re.search(rf"\b{view}\b", text) is not None
