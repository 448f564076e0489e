import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from respan.irt import fit as irt
from respan.irt.chi2 import chi2_upper_tail
from respan.irt.m2 import m2_stats, model_stats


def simulate(spark, n, a, b, spec=None, testlets=None, seed=7, keep=1.0):
    rng = np.random.default_rng(seed)
    theta = rng.normal(size=n)
    eta = np.outer(theta, a) - a * b
    if spec is not None:
        eta += rng.normal(size=(n, testlets.max() + 1))[:, testlets] * spec
    y = (rng.random(eta.shape) < 1 / (1 + np.exp(-eta))).astype(int)
    s, i = np.nonzero(rng.random(eta.shape) < keep)
    t = testlets if testlets is not None else np.zeros(len(a), int)
    names = np.array([f"Q{k + 1:03d}s{t[k] + 1}" for k in range(len(a))])
    pdf = pd.DataFrame({"global_id": [f"g{x:06d}" for x in s], "QID": names[i], "response": y[s, i].astype("int32")})
    return spark.createDataFrame(pdf), theta, names


@pytest.fixture(scope="module")
def two_pl(spark):
    rng = np.random.default_rng(11)
    a, b = rng.uniform(0.7, 2.0, 12), np.linspace(-1.5, 1.5, 12)
    resp, theta, names = simulate(spark, 12_000, a, b)
    return resp.persist(), a, b, theta


def test_2pl_recovers_parameters(spark, two_pl):
    resp, a, b, theta = two_pl
    model = irt.fit_irt(resp, "2pl")
    got = model.params.orderBy("QID").toPandas()
    assert model.fit.collect()[0]["converged"]
    assert np.abs(got["a"] - a).max() < 0.25 and np.abs(got["b"] - b).max() < 0.2
    assert min(y - x for x, y in zip(model.history, model.history[1:])) > -1e-6
    scores = irt.score_eap(resp, model).toPandas().sort_values("global_id")
    assert np.corrcoef(scores["theta"], theta)[0, 1] > 0.8 and scores["SE_theta"].between(0.1, 1.0).all()


def test_rasch_is_nested_in_2pl(spark, two_pl):
    resp = two_pl[0]
    small, big = irt.fit_irt(resp, "rasch"), irt.fit_irt(resp, "2pl", max_iter=60)
    fit = irt.fit_table([small, big])
    row = irt.lrt(fit, "rasch", "2pl").collect()[0]
    assert row["df"] == 11 and row["chi2"] > 0 and 0 <= row["p"] < 0.05
    r = {x["model"]: x for x in fit.collect()}
    assert r["rasch"]["npar"] == 13 and r["2pl"]["npar"] == 24
    assert abs(r["2pl"]["AIC"] - (-2 * r["2pl"]["logLik"] + 48)) < 1e-9
    a = small.params.toPandas()["a"]
    assert (a == 1.0).all() and 0.9 < small.state.grid.sd < 1.6


def test_m2_on_complete_data(spark, two_pl):
    resp = two_pl[0]
    good = irt.fit_irt(resp, "2pl")
    stats = model_stats(resp, [irt.fit_irt(resp, "rasch"), good]).toPandas().set_index("model")
    df = 12 + 66 - 24
    assert stats.loc["2pl", "df_M2"] == df and stats.loc["rasch", "df_M2"] == 78 - 13
    assert 0.5 * df < stats.loc["2pl", "M2"] < 1.6 * df and stats.loc["2pl", "p_M2"] > 0.01
    assert stats.loc["rasch", "M2"] > stats.loc["2pl", "M2"]
    assert stats.loc["2pl", "RMSEA_M2"] < 0.02 and stats.loc["2pl", "CFI_M2"] > 0.98 and stats.loc["2pl", "SRMSR_M2"] < 0.04


def test_m2_is_null_with_missing_answers(spark):
    resp, *_ = simulate(spark, 200, np.ones(5), np.zeros(5), keep=0.6)
    row = m2_stats(resp, irt.fit_irt(resp, "2pl", max_iter=3)).collect()[0]
    assert row["M2"] is None and "missing" in row["reason"]


def test_bifactor_finds_testlet_dependence(spark):
    testlets = np.repeat(np.arange(4), 4)
    a, b = np.full(16, 1.2), np.tile(np.linspace(-1, 1, 4), 4)
    resp, theta, names = simulate(spark, 3000, a, b, spec=np.full(16, 1.2), testlets=testlets)
    fmap = irt.factor_map(resp)
    model = irt.fit_irt(resp, "bifactor", fmap, max_iter=40)
    flat = irt.fit_irt(resp, "2pl", max_iter=40)
    assert model.history[-1] > flat.history[-1] + 100
    assert min(y - x for x, y in zip(model.history, model.history[1:])) > -1e-6
    p = model.params.toPandas()
    assert 0.7 < p["a_specific"].median() < 1.8 and model.state.npar == 48
    scores = irt.score_eap_bifactor(resp, model).toPandas().sort_values("global_id")
    assert np.corrcoef(scores["theta"], theta)[0, 1] > 0.6
    with pytest.raises(ValueError):
        irt.score_eap_bifactor(resp, flat)


def test_one_testlet_bifactor_without_slopes_equals_2pl(spark):
    """With zero specific slopes both posteriors agree (up to the coarser grid)."""
    resp, *_ = simulate(spark, 300, np.ones(8), np.linspace(-1, 1, 8), testlets=np.repeat([0, 1], 4), keep=0.8)
    params = resp.select("QID").distinct().select("QID", F.lit(1.0).alias("a"), F.lit(0.2).alias("d"))
    flat = irt.score_eap(resp, irt.state_from_params(params)).toPandas().set_index("global_id")
    both = params.join(irt.factor_map(resp).select("QID", "factor"), "QID").withColumn("a_specific", F.lit(0.0))
    bif = irt.score_eap(resp, irt.state_from_params(both, "bifactor")).toPandas().set_index("global_id")
    assert np.abs(flat["theta"] - bif["theta"]).max() < 1e-3


def test_degenerate_items_are_reported(spark):
    resp, *_ = simulate(spark, 200, np.ones(4), np.zeros(4))
    flat = resp.select("global_id").distinct().select("global_id", F.lit("Q099s9").alias("QID"), F.lit(1).alias("response"))
    model = irt.fit_irt(resp.unionByName(flat), "2pl", max_iter=3)
    rows = {r["QID"]: r for r in model.params.collect()}
    assert rows["Q099s9"]["status"] == "degenerate" and rows["Q099s9"]["a"] is None and len(rows) == 5


def test_factor_maps(spark):
    items = spark.createDataFrame([("Q001s1",), ("Q002in1",), ("Q010s10",), ("Q011s10",), ("Q005p2",), ("Q006p2",), ("Q020l3",)], "QID string")
    got = {r["QID"]: (r["testlet"], r["factor"]) for r in irt.factor_map(items).collect()}
    assert got["Q020l3"] == (3, None) and got["Q001s1"] == (1, 1) and got["Q005p2"] == (2, 2) and got["Q010s10"] == (10, 3)
    blocks = {r["QID"]: r["factor"] for r in irt.factor_map(items, "blocks", 3).collect()}
    assert blocks["Q001s1"] == 1 and blocks["Q006p2"] == 2 and blocks["Q020l3"] == 3


def test_chi_square_tail():
    for x, df, p in [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (67.50480655, 50, 0.05), (0.0, 3, 1.0)]:
        assert abs(chi2_upper_tail(x, df) - p) < 1e-8
    assert chi2_upper_tail(1e5, 3) == 0.0


def test_m2_equals_the_dense_form():
    """Against covariances summed over all answer patterns."""
    import itertools

    from respan.irt.m2 import quadratic_form
    from respan.irt.model import start_state

    rng = np.random.default_rng(5)
    for kind, factor in (("2pl", None), ("bifactor", {"a": 1, "b": 1, "c": 2, "d": 2, "e": 0, "f": 2})):
        items = list("abcdef")
        state = start_state(kind, items, factor)
        state.coef = state.coef + rng.normal(0, 0.3, state.coef.shape) * state.free
        design = state.grid.design()
        prob = 1 / (1 + np.exp(-(state.coef @ design.T)))
        patterns = np.array(list(itertools.product((0, 1), repeat=6)))
        if kind == "2pl":
            weight = np.exp(state.grid.log_prior)
            p = np.array([weight @ np.prod(np.where(y[:, None] == 1, prob, 1 - prob), axis=0) for y in patterns])
        else:
            g, u = np.exp(state.grid.log_prior), np.exp(state.grid.log_prior_specific)
            p = np.zeros(64)
            for k, y in enumerate(patterns):
                like = np.where(y[:, None] == 1, prob, 1 - prob).reshape(6, len(g), len(u))
                total = g.copy()
                for t in (0, 1, 2):
                    total = total * (np.prod(like[state.factor == t], axis=0) @ u)
                p[k] = total.sum()
        pairs = list(itertools.combinations(range(6), 2))
        f = np.column_stack([patterns, *(patterns[:, i] * patterns[:, j] for i, j in pairs)])
        mean = p @ f
        cov = (f * p[:, None]).T @ f - np.outer(mean, mean)
        from respan.irt.m2 import Margins

        m = Margins(state)
        assert np.allclose(m.single, mean[:6]) and np.allclose([m.pair[i, j] for i, j in pairs], mean[6:])
        for column in range(f.shape[1]):
            x = np.zeros(f.shape[1])
            x[column] = 1
            table = np.zeros((6, 6))
            for (i, j), value in zip(pairs, x[6:]):
                table[i, j] = table[j, i] = value
            v, t = m.covariance(x[:6], table)
            assert np.allclose(np.concatenate([v, [t[i, j] for i, j in pairs]]), cov[column])
        y = patterns[rng.choice(64, 3000)]
        delta = m.jacobian()
        r = np.concatenate([y.mean(0), [(y[:, i] * y[:, j]).mean() for i, j in pairs]]) - mean
        inv = np.linalg.inv(cov)
        want = 3000 * (r @ inv @ r - r @ inv @ delta @ np.linalg.solve(delta.T @ inv @ delta, delta.T @ inv @ r))
        assert quadratic_form(y.T @ y / 3000, 3000, state)["M2"] == pytest.approx(want, rel=1e-6)


def test_m2_of_a_whole_bank(spark):
    """Complete answers to 180 items: a statistic, no cap."""
    from respan.irt.m2 import m2_stats
    from respan.irt.model import start_state

    rng = np.random.default_rng(6)
    theta = rng.normal(size=(300, 1))
    y = (rng.random((300, 180)) < 1 / (1 + np.exp(-theta))).astype(int)
    items = [f"i{k:03d}" for k in range(180)]
    rows = [(f"p{i}", items[k], int(y[i, k])) for i in range(300) for k in range(180)]
    resp = spark.createDataFrame(rows, "global_id string, QID string, response int")
    row = m2_stats(resp, start_state("rasch", items)).first()
    assert row.reason is None and row.df_M2 == 180 * 181 / 2 - 181 and row.RMSEA_M2 < 0.05


def test_more_items_than_a_block(spark):
    """6,000 items: every block is updated, and the likelihood rises."""
    from respan.irt.fit import fit_irt

    rng = np.random.default_rng(7)
    rows = [(f"p{i:03d}", f"i{k:04d}", int(rng.random() < 0.3 + 0.4 * (i % 2))) for i in range(120) for k in range(i % 3, 6000, 3)]
    resp = spark.createDataFrame(rows, "global_id string, QID string, response int")
    model = fit_irt(resp, "2pl", max_iter=3)
    assert len(model.state.items) > 5000 and all(b > a for a, b in zip(model.history, model.history[1:]))


def test_fit_of_nothing_and_of_wrong_answers(spark):
    from respan.irt.fit import fit_irt
    from respan.operators.quality import GateError

    none = spark.createDataFrame([], "global_id string, QID string, response int")
    row = fit_irt(none, "2pl").fit.first()
    assert row.n_items == 0 and row.logLik is None and not row.converged
    with pytest.raises(GateError):
        fit_irt(spark.createDataFrame([("p", "i", 2)], "global_id string, QID string, response int"), "2pl")


@pytest.mark.parametrize("kind", ["rasch", "2pl", "bifactor"])
def test_fit_on_patterns_equals_fit_on_respondents(spark, kind):
    """With gaps, so that equal answers to other items must stay apart."""
    resp, _, _ = simulate(spark, 600, np.full(6, 1.2), np.linspace(-1, 1, 6), spec=0.8, testlets=np.array([0, 0, 0, 1, 1, 1]), keep=0.9)
    packed = irt.prepare(resp)
    rows = irt.collapse(packed.data, kind)
    assert rows.count() < packed.data.count() and rows.agg(F.sum("weight")).first()[0] == packed.data.count()
    one, each = (irt.fit_irt(packed, kind, max_iter=15, collapsed=c) for c in (True, False))
    np.testing.assert_allclose(one.history, each.history, rtol=1e-9)
    np.testing.assert_allclose(one.state.coef, each.state.coef, atol=1e-6)
    assert one.fit.first()["n_respondents"] == each.fit.first()["n_respondents"] == packed.data.count()


def test_m2_has_values_on_complete_answers(spark):
    import __spark_entry__ as entry

    row = entry.queries()["m2_complete"](spark, "/root/testdata/sf0.01").first()
    assert row["reason"] is None and row["M2"] > 0 and row["df_M2"] == 9 and 0 <= row["p_M2"] <= 1
