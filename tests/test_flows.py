from catalog.views import Fixtures
from respan.irt.fit import fit_irt
from respan.operators import matching
from respan.operators.trim import TrimLimits
from respan.plans import flows

SF = "/root/testdata/sf0.001"


def test_selection_flow(spark):
    fx = Fixtures(spark, SF)
    report = flows.selection_flow(fx.response, fx.respondent).collect()
    assert len(report) == 36 and all(r["subtitle"] for r in report)


def test_review_round_trip(spark):
    fx = Fixtures(spark, SF)
    t = fx.template.filter("source_name = 'edited'")
    empty = t.filter("false").selectExpr("*", "null as QID", "cast(null as string) match_method", "cast(null as double) string_distance")
    prompts = flows.review_input(t, empty, empty, fx.bank, 3)
    rows = prompts.orderBy("audit_row").collect()
    assert len(rows) == t.count() and rows[0]["audit_status"] == "pending" and rows[0]["candidates_text"].count("\n") >= 2
    done = prompts.selectExpr(
        "audit_row", "source_name", "question_id", "domainId", "source_stem",
        "case when audit_row % 2 = 0 then regexp_extract(candidates_text, '^1. ([^ ]+)', 1) end as human_final_qid",
        "case when audit_row % 2 = 0 then 'accept' else 'reject' end as human_final_decision",
    )
    result = flows.review_output(done, matching.audit_cases(t, empty, empty), fx.bank)
    accepted = sum(r["audit_row"] % 2 == 0 for r in rows)
    assert result.patches.count() == accepted == result.cases.filter("final_QID is not null").count()
    assert result.summary.collect()[0]["n_final_patches"] == accepted
    assert result.unresolved.count() == len(rows) - accepted


def test_trim_flow(spark):
    fx = Fixtures(spark, SF)
    full = fit_irt(fx.response, "2pl", max_iter=3)
    out = flows.trim_flow(fx.response, fx.respondent, full, TrimLimits(min_n=20), max_iter=3)
    kept, dropped = out.kept.count(), out.dropped.count()
    assert kept and dropped and kept + dropped == 180
    assert out.scores.count() == fx.respondent.count() and "absdiff_full_trimmed" in out.scores.columns


def test_compare_flow(spark):
    fx = Fixtures(spark, SF)
    out = flows.compare_flow(fx.response, fx.respondent, max_iter=2)
    assert out.fit.count() == 3 and not out.fit.filter("converged").count()
    row = out.scores.filter("theta_rasch is not null").first()
    assert abs(row["diff_2pl_bif"] - (row["theta_2pl"] - row["theta_bifactor"])) < 1e-12
