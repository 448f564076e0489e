"""Queries for reshaping, item-response models, diagnostics, trimming and score comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.basic import respondents
from catalog.registry import query
from respan.functions.qid import item_lookup
from respan.irt import fit as irt
from respan.irt.m2 import m2_stats as m2, model_stats as all_stats
from respan.lineage import cut_lineage, scratch_path
from respan.operators import compare, rows
from respan.operators.counts import item_counts
from respan.operators.quality import Gate, allowed_values
from respan.sources import publish as publishing
from respan.operators.trim import (
    TrimLimits, flag_summary as flags, item_diagnostics as diagnose, ranked_items, trim_pools as pools,
    trim_review as review,
)

# limits that make every flag fire at some items of the fixture
LIMITS = TrimLimits(low_a=0.8, high_a=1.7, extreme_b=1.4, min_n=200, low_p=0.3, high_p=0.8)


def diagnostics(fx):
    counts = item_counts(fx.response).select("QID", "n_responded", "prop_correct")
    return diagnose(item_lookup(fx.params), counts, fx.params.select("QID", "a", "b"), LIMITS)


def fixed_model(fx, kind="2pl", items="true"):
    """Rasch or 2PL with the true parameters of the fixture."""
    a = F.lit(1.0) if kind == "rasch" else F.col("a")
    return irt.state_from_params(fx.params.where(items).select("QID", a.alias("a"), "b"))


def fixed_fit(fx, items="true"):
    """Fit rows of the fixed models (npar as in a free fit)."""
    out, packed = [], None
    for name in ("rasch", "2pl"):
        state = fixed_model(fx, name, items)
        n = len(state.items)
        packed = packed or irt.pack(fx.response, state.items)  # the models have the same items
        npar = n + 1 if name == "rasch" else 2 * n
        out.append(
            irt.log_likelihood(packed, state).select(
                F.lit(name).alias("model"), F.lit(n).alias("n_items"), F.lit(npar).alias("npar"), "n_respondents", "logLik"
            )
        )
    return rows.stack(*out)


def fixed_bifactor(fx):
    """Bifactor with the true slopes and specific slopes of 0.5."""
    known = cut_lineage(fx.params.select("QID", "a", "b"))  # one row per item, used twice
    fmap = irt.factor_map(known).select("QID", "factor")
    params = known.join(fmap, "QID").withColumn("a_specific", F.lit(0.5))
    return irt.state_from_params(params, "bifactor")


# ---- reshape -------------------------------------------------------------

def item_ids(n: int = 180) -> list[str]:
    """The ids of the bank of ``fx_response``, by its rule."""
    codes = ("s", "in", "id", "p", "l")
    return [f"Q{k:03d}{codes[k % 5]}{(k + 5) // 6}" for k in range(1, n + 1)]


@query("select global_id, QID, response from fx_response")
def to_long(fx):
    return rows.to_long(rows.to_wide(fx.response, item_ids()))


@query("select global_id, " + ", ".join(f"min(response) filter (QID='{q}') as {q}" for q in item_ids()) + " from fx_response group by global_id")
def to_wide(fx):
    return rows.to_wide(fx.response, item_ids())


# ---- estimation ----------------------------------------------------------

def _fit_row(model):
    return irt.fit_table([model]).select("model", "n_items", "npar", "logLik", "AIC", "BIC", "converged")


@query()
def fit_rasch(fx):
    return _fit_row(irt.fit_irt(fx.response, "rasch"))


@query()
def fit_2pl(fx):
    return _fit_row(irt.fit_irt(fx.response, "2pl"))


@query()
def fit_bifactor(fx):
    """Specific slopes drift on long after the likelihood has settled, so its gain is what stops the fit."""
    return _fit_row(irt.fit_irt(fx.response, "bifactor", tol_loglik=1e-6))


@query()
def fit_2pl_params(fx):
    return irt.fit_irt(fx.response, "2pl").params


_GRID = "(select i as {0}, -4.5+0.45*i as {0}v, -0.5*power(-4.5+0.45*i,2) - ln(sum(exp(-0.5*power(-4.5+0.45*i,2))) over ()) as {0}w from range(21) t(i))"

# bifactor: share of each node of a testlet's own factor given the general one, and the general posterior with its log marginal
_BIFACTOR_CELLS = f"""ce as (select r.global_id, l.testlet, g.g, u.u, any_value(u.uw)
   + sum(case when response=1 then -ln(1+exp(-(p.a*g.gv + 0.5*u.uv - p.a*p.b))) else -ln(1+exp(p.a*g.gv + 0.5*u.uv - p.a*p.b)) end) as l
  from fx_response r join fx_params p using (QID) join or_lookup l using (QID) cross join {_GRID.format('g')} g cross join {_GRID.format('u')} u group by 1,2,3,4),
 c as (select *, exp(l) / sum(exp(l)) over (partition by global_id, testlet, g) as share from ce),
 tl as (select global_id, testlet, g, ln(sum(exp(l))) as l from ce group by 1,2,3),
 g0 as (select global_id, g, sum(l) + any_value(gw) as l from tl join {_GRID.format('g')} x using (g) group by 1,2),
 pg as (select global_id, g, exp(l - m) / sum(exp(l - m)) over (partition by global_id) as w, m + ln(sum(exp(l - m)) over (partition by global_id)) as lm
  from (select *, max(l) over (partition by global_id) as m from g0) t)"""


@query("""select p.QID, n.node::int as node, round(sum(w),6) as n, round(sum(w*response),6) as r from or_post p0 join fx_response p using (global_id) join or_nodes n on n.node = p0.node group by p.QID, n.node""")
def e_step(fx):
    return irt.e_step(fx.response, fixed_model(fx))


@query("""with p as (select *, exp(l - m) / sum(exp(l - m)) over (partition by global_id) as w from (select *, max(l) over (partition by global_id) as m from or_ll_rasch) t)
 select r.QID, p.node::int as node, round(sum(w),6) as n, round(sum(w*response),6) as r from p join fx_response r using (global_id) group by r.QID, p.node""")
def e_step_rasch(fx):
    """Over respondents of equal items and equal number right as one row each."""
    return irt.e_step(fx.response, fixed_model(fx, "rasch"), collapsed=True)


@query(f"""with {_BIFACTOR_CELLS}, j as (select c.global_id, c.testlet, c.u, sum(pg.w * c.share) as w from c join pg using (global_id, g) group by all)
 select QID, u::int as u, round(sum(w),6) as n, round(sum(w*response),6) as r from fx_response join or_lookup using (QID) join j using (global_id, testlet) group by all""")
def e_step_bifactor(fx):
    """Expected answers at the nodes of each item's own factor."""
    state = fixed_bifactor(fx)
    sums = irt.e_step(fx.response, state, collapsed=True)
    u = F.pmod("node", F.lit(len(state.grid.specific))).alias("u")
    return sums.groupBy("QID", u).agg(F.sum("n").alias("n"), F.sum("r").alias("r"))


@query(f"""with {_BIFACTOR_CELLS}, ps as (select global_id, string_agg(QID || '=' || response, ',' order by QID) as p, string_agg(QID, ',' order by QID) || ':' || sum(response) as q from fx_response group by global_id)
 select 'rasch' as model, round(logLik,4) as logLik, n_respondents, (select count(distinct q) from ps) as n_patterns from or_fit where model = 'rasch'
 union all select '2pl', round(logLik,4), n_respondents, (select count(distinct p) from ps) from or_fit where model = '2pl'
 union all select 'bifactor', round(sum(lm),4), count(*), (select count(distinct p) from ps) from (select global_id, any_value(lm) as lm from pg group by global_id) t""")
def pattern_log_likelihood(fx):
    """The three models at fixed parameters, summed over answer patterns."""
    models = {"rasch": fixed_model(fx, "rasch"), "2pl": fixed_model(fx), "bifactor": fixed_bifactor(fx)}
    packed = irt.pack(fx.response, models["rasch"].items)  # the models have the same items
    return rows.stack(*[irt.pattern_log_likelihood(packed, m).withColumn("model", F.lit(name)) for name, m in models.items()]).withColumn("logLik", F.round("logLik", 4))


@query("""with l as (select testlet::int as testlet, QID from or_lookup) select testlet as factor, testlet, list(rn order by rn) as item_indices, count(*) as n_items
 from (select QID, row_number() over (order by QID)::int as rn from or_lookup) x join l using (QID) group by testlet having count(*) >= 2""")
def factor_map(fx):
    return irt.factor_items(irt.factor_map(fx.params))


@query("select QID, rn::int as item_index, ((rn+5)//6)::int as testlet, ((rn+5)//6)::int as factor from (select QID, row_number() over (order by QID) as rn from or_lookup) t")
def factor_blocks(fx):
    return irt.factor_map(fx.params, "blocks")


@query("select global_id, round(sum(w*theta),6)+0.0 as theta, round(sqrt(sum(w*theta*theta)-power(sum(w*theta),2)),6) as SE_theta from or_post group by global_id")
def score_eap(fx):
    return irt.score_eap(fx.response, fixed_model(fx))


@query("select global_id, round(any_value(lm),6) as log_marginal from or_post group by global_id")
def log_marginal(fx):
    return irt.posteriors(fx.response, fixed_model(fx)).select("global_id", "log_marginal")




@query(f"""with cell as (select r.global_id, l.testlet, g.g, u.u, any_value(g.gv) as gv, any_value(u.uw)
   + sum(case when response=1 then -ln(1+exp(-(p.a*g.gv + 0.5*u.uv - p.a*p.b))) else -ln(1+exp(p.a*g.gv + 0.5*u.uv - p.a*p.b)) end) as l
  from fx_response r join fx_params p using (QID) join or_lookup l using (QID) cross join {_GRID.format('g')} g cross join {_GRID.format('u')} u group by 1,2,3,4),
 tl as (select global_id, testlet, g, any_value(gv) as gv, ln(sum(exp(l))) as l from cell group by 1,2,3),
 pg as (select global_id, g, any_value(gv) as gv, sum(l) as l from tl group by 1,2),
 w as (select global_id, pg.gv, l + gw as l from pg join {_GRID.format('g')} x using (g)),
 n as (select global_id, gv, exp(l - max(l) over (partition by global_id)) as e from w)
 select global_id, round(sum(e*gv)/sum(e),6)+0.0 as theta, round(sqrt(sum(e*gv*gv)/sum(e) - power(sum(e*gv)/sum(e),2)),6) as SE_theta from n group by global_id""")
def score_eap_bifactor(fx):
    return irt.score_eap_bifactor(fx.response, fixed_bifactor(fx))


@query("select QID, round(a,6) as a, round(-(-a*b)/a,6)+0.0 as b, round(-a*b,6)+0.0 as d from fx_params")
def item_params(fx):
    state = fixed_model(fx)
    return irt.params_table(fx.spark, state).select("QID", "a", "b", "d")


@query("select model, n_items, npar, n_respondents, round(logLik,6) as logLik, round(-2*logLik+2*npar,6) as AIC, round(-2*logLik+npar*ln((n_respondents+2)/24.0),6) as SABIC, round(-2*logLik+2*npar*ln(ln(n_respondents)),6) as HQ, round(-2*logLik+npar*ln(n_respondents),6) as BIC from or_fit")
def fit_table(fx):
    return irt.fit_statistics(fixed_fit(fx)).select(
        "model", "n_items", "npar", "n_respondents", "logLik", "AIC", "SABIC", "HQ", "BIC"
    )


@query("select 'rasch' as small, '2pl' as big, round(2*(b.logLik-s.logLik),6) as chi2, b.npar-s.npar as df from or_fit s, or_fit b where s.model='rasch' and b.model='2pl'")
def lrt_statistic(fx):
    return irt.lrt_statistic(fixed_fit(fx), "rasch", "2pl")


_LL = """(select sum(lm) from (select max(l) + ln(sum(exp(l - m))) as lm from (select *, max(l) over (partition by global_id) as m from (
  select r.global_id, n.node, any_value(n.lw) + sum(case when response=1 then -ln(1+exp(-{0}*(n.theta-p.b))) else -ln(1+exp({0}*(n.theta-p.b))) end) as l
  from fx_response r join fx_params p using (QID) cross join or_nodes n where substr(QID,2,3) <> '001' group by r.global_id, n.node) t) u group by global_id) v)"""


@query(f"""with f as (select 2 * ({_LL.format('p.a')} - {_LL.format('1')}) as chi2, (select count(*) - 1 from fx_params where substr(QID,2,3) <> '001')::int as df)
 select 'rasch' as small, '2pl' as big, round(chi2, 4) as chi2, df, round(case when chi2 <= 0 then 1 else (select sum(exp(-chi2 / 2 + i * ln(chi2 / 2) - lgamma(i + 1))) from range(0, 500) t(i) where i < df / 2) end, 6) as p from f where df % 2 = 0""")
def lrt(fx):
    """On an odd number of items, so that the degrees of freedom are even and SQL can sum the tail."""
    fit = fixed_fit(fx, "substring(QID, 2, 3) <> '001'")
    return irt.lrt(fit, "rasch", "2pl").where("df % 2 = 0").withColumn("chi2", F.round("chi2", 4))


@query("select x.QID as QID_1, y.QID as QID_2, count(*) as n, sum(x.response*y.response)::bigint as n_correct from fx_response x join fx_response y on x.global_id=y.global_id and x.QID < y.QID group by 1,2")
def item_pair_margins(fx):
    return irt.item_pair_margins(fx.response)


@query()
def m2_stats(fx):
    """The fixture is sparse, so the statistics are null and the reason says why."""
    return m2(fx.response, fixed_model(fx))


@query()
def model_stats(fx):
    packed = irt.prepare(fx.response)
    return all_stats(packed, [irt.fit_irt(packed, k) for k in ("rasch", "2pl")])


def complete_answers(fx):
    """Answers to the first testlet of those who answered all of it: a table without gaps that grows with the respondents."""
    own = cut_lineage(fx.response.where(F.regexp_extract("QID", "([0-9]+)$", 1) == "1"))  # used more than once
    whole = own.groupBy("global_id").agg(F.count("*").alias("n")).where("n = 6").select("global_id")
    return own.join(whole, "global_id", "left_semi")


@query()
def m2_complete(fx):
    """M2 of fixed parameters on answers without gaps."""
    resp = complete_answers(fx)
    items = [r.QID for r in resp.select("QID").distinct().collect()]
    return m2(resp, irt.state_from_params(fx.params.where(F.col("QID").isin(items)).select("QID", "a", "b")))


@query()
def model_stats_complete(fx):
    """Rasch and 2PL fitted to answers without gaps, with their M2 statistics."""
    packed = irt.prepare(complete_answers(fx))
    return all_stats(packed, [irt.fit_irt(packed, k) for k in ("rasch", "2pl")])


@query("select global_id, round(sum(w*theta),6)+0.0 as theta, round(sqrt(sum(w*theta*theta)-power(sum(w*theta),2)),6) as SE_theta from or_post group by global_id")
def read_model(fx):
    """Scores from a model that was published and read back."""
    state = fixed_model(fx)
    params, fit = irt.params_table(fx.spark, state), fixed_fit(fx).where("model = '2pl'")
    path = scratch_path(fx.spark, "published")
    publishing.publish_model(irt.FittedModel("2pl", state, params, fit, []), path)
    return irt.score_eap(fx.response, publishing.read_model(fx.spark, path))


@query("""select 'answers' as "table", 'response_allowed' as gate, 'stop' as severity, count(*) filter (response not in (0,1)) as n_violations, min(global_id) filter (response not in (0,1)) as sample, count(*) as n_rows from fx_retest
 union all select 'answers', 'late_testlet', 'warn', count(*) filter (substr(QID,2,3) > '170'), min(global_id) filter (substr(QID,2,3) > '170'), count(*) from fx_retest""")
def publish_gates(fx):
    """Gates watched in the job that writes the answers, and the rows that were published."""
    late = Gate("late_testlet", F.substring("QID", 2, 3) > "170", "warn")
    path = scratch_path(fx.spark, "published")
    report = publishing.publish({"answers": fx.retest}, path, {"answers": [allowed_values("response", (0, 1)), late]}, {"answers": "global_id"})
    n = publishing.read_published(fx.spark, path)["answers"].agg(F.count("*").alias("n_rows"))
    return report.crossJoin(F.broadcast(n))


# ---- diagnostics and trimming --------------------------------------------

_DIAG = "QID, testlet, domain_code, domain, n_responded, round(prop_correct,6) as prop_correct, round(a,6) as a, round(b,6)+0.0 as b, flag_low_a, flag_high_a, flag_extreme_b, flag_low_n, flag_poor_p, n_flags, trim_candidate"


@query(f"select {_DIAG} from or_flags")
def item_diagnostics(fx):
    return diagnostics(fx)


@query("select QID, trim_candidate, n_flags from or_flags order by trim_candidate desc, n_flags desc, a, abs(b) desc, QID")
def items_worst_first(fx):
    return ranked_items(diagnostics(fx)).select("QID", "trim_candidate", "n_flags")


@query(" union all ".join(f"select '{f}' as criterion, count(*) filter ({c}) as n_items from or_flags" for f, c in [(x, x) for x in ("flag_low_a", "flag_high_a", "flag_extreme_b", "flag_low_n", "flag_poor_p")] + [("any_flag", "trim_candidate")]))
def flag_summary(fx):
    return flags(diagnostics(fx))


@query("select f.QID, trim_candidate, case when l.legacy_QID is not null then false else trim_candidate end as drop_item, case when l.legacy_QID is not null then 'keep' end as reviewer_note from or_flags f left join fx_legacy l on f.QID = l.legacy_QID")
def trim_review(fx):
    decided = fx.legacy.select(F.col("legacy_QID").alias("QID"), F.lit(False).alias("drop_item"), F.lit("keep").alias("reviewer_note"))
    decided = decided.unionByName(decided.withColumn("reviewer_note", F.lit("later")))
    return review(diagnostics(fx), decided).select("QID", "trim_candidate", "drop_item", "reviewer_note")


@query("select QID, case when trim_candidate then 'dropped' else 'retained' end as pool from or_flags")
def trim_pools(fx):
    kept, dropped = pools(review(diagnostics(fx)))
    return kept.withColumn("pool", F.lit("retained")).unionByName(dropped.withColumn("pool", F.lit("dropped")))


# ---- score comparison ----------------------------------------------------

_POST = """{0}_ll as (select r.global_id, n.node, any_value(n.theta) as theta, any_value(n.lw) + sum(case when response=1 then -ln(1+exp(-p.a*(n.theta-p.b))) else -ln(1+exp(p.a*(n.theta-p.b))) end) as l
  from fx_response r join fx_params p using (QID) cross join or_nodes n where {1} group by r.global_id, n.node),
 {0}_w as (select *, exp(l - max(l) over (partition by global_id)) as e from {0}_ll),
 {0}_s as (select global_id, sum(e*theta)/sum(e) as theta, sqrt(greatest(sum(e*theta*theta)/sum(e) - power(sum(e*theta)/sum(e),2),0)) as se from {0}_w group by global_id)"""


@query(f"with {_POST.format('f', 'true')}, {_POST.format('t', 'p.a >= 1')} " + """select r.global_id, round(f_s.theta,6)+0.0 as theta_full, round(f_s.se,6) as SE_theta_full, round(t_s.theta,6)+0.0 as theta_trimmed, round(t_s.se,6) as SE_theta_trimmed,
 round(f_s.theta-t_s.theta,6)+0.0 as diff_full_trimmed, round(abs(f_s.theta-t_s.theta),6) as absdiff_full_trimmed, round((f_s.theta+t_s.theta)/2,6)+0.0 as avg_full_trimmed
 from fx_respondent r left join f_s using (global_id) left join t_s using (global_id)""")
def compare_scores(fx):
    pool = fx.params.filter("a >= 1")
    full = irt.score_eap(fx.response, irt.state_from_params(fx.params.select("QID", "a", "b")))
    part = irt.score_eap(rows.restrict_items(fx.response, pool), irt.state_from_params(pool.select("QID", "a", "b")))
    return compare.compare_scores(fx.respondent.select("global_id"), full, part)


@query("select global_id, " + ", ".join(f"round({k}_{n},6)+0.0 as {k}_{n}" for n in ("rasch_2pl", "rasch_bif", "2pl_bif") for k in ("diff", "absdiff", "avg")) + " from or_compare")
def compare_models(fx):
    from catalog.summary import PAIRS, compared

    return compared(fx).select("global_id", *[f"{k}_{n}" for n in PAIRS for k in ("diff", "absdiff", "avg")])
