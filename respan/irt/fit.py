"""Model fitting, scoring, fit statistics and likelihood-ratio tests."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window as W, functions as F
from pyspark.sql.types import DoubleType
import pandas as pd

from respan.functions.qid import testlet
from respan.irt.chi2 import chi2_upper_tail
from respan.irt.estep import collapse, em_step, expected_sums, item_list, pack_responses, pair_sums, respondent_posteriors
from respan.irt.model import Grid, ModelState, grid_1d, grid_bifactor, start_state
from respan.lineage import cut_lineage
from respan.operators.quality import GateError, response_gates
from respan.operators.rows import testlet_blocks

_PARAM_DDL = (
    "QID string, a double, a_specific double, d double, b double, g double, u double, factor int, "
    "at_bound boolean, status string"
)
_FIT_DDL = (
    "model string, n_items int, npar int, n_respondents long, logLik double, sd_theta double, "
    "iterations int, converged boolean"
)


@dataclass
class FittedModel:
    """Item-sized results; ``params`` and ``fit`` are DataFrames to join or to write."""

    name: str
    state: ModelState
    params: DataFrame
    fit: DataFrame
    history: list[float]


# ---- factor maps ---------------------------------------------------------

def factor_map(items: DataFrame, how: str = "qid", block: int = 6) -> DataFrame:
    """Specific factor of every item: blocks of consecutive items, or the testlet of the QID.

    By QID, testlets with fewer than two items get no factor; factors are numbered by
    testlet in numeric order.  Output ``QID, item_index, testlet, factor`` (factor null =
    general only).  ``items`` has one row per item.
    """
    ranked = testlet_blocks(items, block)
    if how == "blocks":
        return ranked.withColumn("factor", F.col("testlet"))
    by_qid = ranked.withColumn("testlet", testlet(F.col("QID")).cast("int"))
    shared = by_qid.groupBy("testlet").agg(F.count("*").alias("_n")).filter("_n >= 2 and testlet is not null")
    numbered = shared.withColumn("factor", F.row_number().over(W.orderBy("testlet"))).drop("_n")
    return by_qid.join(numbered, "testlet", "left").select("QID", "item_index", "testlet", "factor")


def factor_items(fmap: DataFrame) -> DataFrame:
    """Item positions per factor, as sorted lists bounded by the item list."""
    return (
        fmap.filter(F.col("factor").isNotNull())
        .groupBy("factor")
        .agg(
            F.first("testlet").alias("testlet"),
            F.sort_array(F.collect_list("item_index")).alias("item_indices"),
            F.count("*").alias("n_items"),
        )
    )


# ---- fitting -------------------------------------------------------------

@dataclass
class PackedResponses:
    """Answers packed once, for any number of fits and scores over the same items."""

    data: DataFrame
    items: list[str]
    degenerate: list[str]  # answered all right or all wrong: not fitted


def prepare(resp: DataFrame) -> PackedResponses:
    """Two passes over the responses: gates and counts of the items (one row each), packing (and checkpoint).

    Answers outside 0 and 1 and rows without a respondent or item raise ``GateError``.  The packed
    answers lie in a few partitions for each core, so an iteration's sums do not grow with the
    number of tasks that read the input.
    """
    found = _gated_counts(resp)
    flat = {r["QID"] for r in found if not r["n_wrong"] or not r["n_correct"]}
    items = sorted(r["QID"] for r in found if r["QID"] not in flat)
    return PackedResponses(_kept(pack_responses(resp, items)), items, sorted(flat))


def pack(resp: DataFrame, items: list[str]) -> PackedResponses:
    """The answers to these items packed and kept in one pass, for several models of known parameters."""
    return PackedResponses(_kept(pack_responses(resp, items)), items, [])


def _kept(packed: DataFrame) -> DataFrame:
    return cut_lineage(packed.coalesce(4 * packed.sparkSession.sparkContext.defaultParallelism))


def _gated_counts(resp: DataFrame) -> list[Row]:
    """``QID, n_wrong, n_correct`` of the answered items; the gates are summed in the same pass, by item."""
    y, gates = F.col("response"), response_gates()
    aggs = [F.count_if(y == 0).alias("n_wrong"), F.count_if(y == 1).alias("n_correct")]
    aggs += [F.count_if(F.coalesce(g.violation, F.lit(False))).alias(f"v{i}") for i, g in enumerate(gates)]
    found = resp.groupBy("QID").agg(*aggs).collect()
    for i, g in enumerate(gates):
        wrong = [r for r in found if r[f"v{i}"]]
        if wrong:
            sample = min((r["QID"] for r in wrong if r["QID"] is not None), default=None)
            raise GateError(f"{g.name}: {sum(r[f'v{i}'] for r in wrong)} rows, e.g. {sample}")
    return [r for r in found if r["n_wrong"] + r["n_correct"] > 0]


def packed_for(resp: DataFrame | PackedResponses, items: list[str]) -> DataFrame:
    """The packed answers to exactly these items."""
    if not isinstance(resp, PackedResponses):
        return pack_responses(resp, items)
    if resp.items != items:
        raise ValueError("the responses were packed for other items")
    return resp.data


def fit_irt(
    resp: DataFrame | PackedResponses,
    kind: str,
    factors: DataFrame | None = None,
    name: str | None = None,
    max_iter: int = 500,
    tol: float = 1e-4,
    tol_loglik: float = 0.0,
    grid: Grid | None = None,
    slope_bound: float | None = 10.0,
    collapsed: bool = True,
) -> FittedModel:
    """Marginal maximum likelihood by EM: ``rasch``, ``2pl`` or ``bifactor``.

    Each iteration is one Spark job over the different answer patterns with their counts (for the Rasch model over
    items and number of right answers; ``collapsed=False``: over the respondents); blocks of items are updated in
    tasks and their coefficients come back.  ``slope_bound`` keeps slopes within bounds (None: free),
    which ``at_bound`` reports.  Without answers or items the fit is a row of nulls with
    ``converged = false``.  Stops when no estimate moves by ``tol``, or when the
    log-likelihood gains less than ``tol_loglik`` (relative); ``converged`` tells whether
    it did within ``max_iter``.
    """
    prepared = resp if isinstance(resp, PackedResponses) else prepare(resp)
    packed, items, flat = prepared.data, prepared.items, prepared.degenerate
    spark = packed.sparkSession
    mapping = None
    if kind == "bifactor":
        if factors is None:
            factors = factor_map(spark.createDataFrame([(q,) for q in items], "QID string"))
        mapping = {r["QID"]: r["factor"] for r in factors.filter("factor is not null").collect()}
    state = start_state(kind, items, mapping, grid)
    label = name or kind
    if not items:
        fit = spark.createDataFrame([(label, 0, None, 0, None, None, 0, False)], _FIT_DDL)
        return FittedModel(label, state, params_table(spark, state, flat), fit, [])
    if collapsed:
        packed = cut_lineage(collapse(packed, kind).coalesce(4 * spark.sparkContext.defaultParallelism))
    packed.persist()
    try:
        history: list[float] = []
        converged, done = False, 0
        for done in range(1, max_iter + 1):
            coef, loglik, people, second = em_step(packed, state, slope_bound)
            history.append(loglik)
            moved = float(np.abs(coef - state.coef).max())
            grid = state.grid
            if kind == "rasch":
                sd = float(np.sqrt(second / people))
                moved = max(moved, abs(sd - grid.sd))
                grid = Grid(grid.general, sd=sd)
            state = ModelState(kind, items, grid, coef, state.free, state.factor)
            gain = abs(history[-1] - history[-2]) if len(history) > 1 else np.inf
            if moved < tol or gain < tol_loglik * abs(loglik):
                converged = True
                break
        _, loglik, people, _ = em_step(packed, state, slope_bound)
        history.append(loglik)
    finally:
        packed.unpersist()
    fit = spark.createDataFrame(
        [(label, len(items), state.npar, people, loglik, state.grid.sd, done, converged)], _FIT_DDL
    )
    return FittedModel(label, state, params_table(spark, state, flat, slope_bound), fit, history)


def params_table(spark: SparkSession, state: ModelState, flat: list[str] = (), slope_bound: float | None = None) -> DataFrame:
    """Item parameters, b = -d / a; degenerate items are listed with null estimates."""
    rows = []
    for i, q in enumerate(state.items):
        c = [float(x) for x in state.coef[i]]
        a, d = c[0], c[-1]
        spec = c[1] if state.kind == "bifactor" else None
        factor = int(state.factor[i]) or None if state.kind == "bifactor" else None
        bound = slope_bound is not None and bool(np.any(np.abs(state.coef[i, :-1]) >= slope_bound))
        rows.append((q, a, spec, d, -d / a if a else None, 0.0, 1.0, factor, bound, "estimated"))
    rows += [(q, None, None, None, None, None, None, None, False, "degenerate") for q in flat]
    return spark.createDataFrame(rows, _PARAM_DDL)


def item_params(model: FittedModel) -> DataFrame:
    """The a/b form used by the diagnostics."""
    return model.params.select("QID", "a", "b", "g", "u")


# ---- scoring -------------------------------------------------------------

def state_from_params(params: DataFrame, kind: str = "2pl", sd: float = 1.0) -> ModelState:
    """Model with known parameters (``QID, a, b`` or ``QID, a, d [, a_specific, factor]``).

    Item-sized collect.
    """
    have = params.columns
    d = F.col("d") if "d" in have else -F.col("a") * F.col("b")
    cols = [F.col("QID"), F.col("a").alias("a"), d.alias("d")]
    if kind == "bifactor":
        cols += [F.coalesce("a_specific", F.lit(0.0)).alias("s"), F.coalesce("factor", F.lit(0)).alias("f")]
    rows = sorted((r for r in params.select(*cols).collect() if r["a"] is not None and r["d"] is not None), key=lambda r: r["QID"])
    factor = {r["QID"]: r["f"] for r in rows if r["f"]} if kind == "bifactor" else None
    state = start_state(kind, [r["QID"] for r in rows], factor)
    if kind == "bifactor":
        state.coef = np.array([[r["a"], r["s"], r["d"]] for r in rows], dtype=float)
        state.grid = grid_bifactor()
    else:
        state.coef = np.array([[r["a"], r["d"]] for r in rows], dtype=float)
        state.grid = grid_1d(sd=sd)
    return state


def _as_state(model) -> ModelState:
    return model.state if isinstance(model, FittedModel) else model


def posteriors(resp: DataFrame | PackedResponses, model: FittedModel | ModelState) -> DataFrame:
    state = _as_state(model)
    return respondent_posteriors(packed_for(resp, state.items), state)


def score_eap(resp: DataFrame | PackedResponses, model: FittedModel | ModelState) -> DataFrame:
    """EAP score and its SE per respondent, for any of the models (bifactor: general factor).

    Respondents without an answer to the model's items have no row; the left join of
    ``attach_scores`` leaves their score null.
    """
    return posteriors(resp, model).select("global_id", "theta", "SE_theta")


def score_eap_bifactor(resp: DataFrame | PackedResponses, model: FittedModel | ModelState) -> DataFrame:
    if _as_state(model).kind != "bifactor":
        raise ValueError("not a bifactor model")
    return score_eap(resp, model)


def log_likelihood(resp: DataFrame | PackedResponses, model: FittedModel | ModelState) -> DataFrame:
    """One row: marginal log-likelihood and the number of respondents."""
    return posteriors(resp, model).agg(
        F.sum("log_marginal").alias("logLik"), F.count("*").alias("n_respondents")
    )


def e_step(resp: DataFrame, model: FittedModel | ModelState, collapsed: bool = False) -> DataFrame:
    """QID, theta node, expected answers n, expected correct r under the given parameters.

    With ``collapsed`` the sums run over answer patterns with their counts, as in a fit.
    """
    state = _as_state(model)
    spark = resp.sparkSession
    packed = pack_responses(resp, state.items)
    sums = expected_sums(collapse(packed, state.kind) if collapsed else packed, state).filter("item >= 0")
    names = spark.createDataFrame([(i, q) for i, q in enumerate(state.items)], "item int, QID string")
    return sums.join(F.broadcast(names), "item").select("QID", "node", "n", "r")  # item-sized


def pattern_log_likelihood(resp: DataFrame | PackedResponses, model: FittedModel | ModelState) -> DataFrame:
    """One row: marginal log-likelihood, the number of respondents, and of rows they collapse to in a fit."""
    state = _as_state(model)
    rows = cut_lineage(collapse(packed_for(resp, state.items), state.kind))
    total = expected_sums(rows, state).filter("item = -1 and node = 0")
    n_rows = rows.agg(F.count("*")).scalar()
    return total.select(F.col("n").alias("logLik"), F.round("r").cast("long").alias("n_respondents"), n_rows.alias("n_patterns"))


# ---- fit statistics ------------------------------------------------------

def fit_statistics(fit: DataFrame) -> DataFrame:
    """AIC, SABIC, HQ and BIC from logLik, npar and n_respondents."""
    dev, k, n = -2.0 * F.col("logLik"), F.col("npar"), F.col("n_respondents").cast("double")
    log_n = F.when(n > 0, F.log(n))
    return fit.withColumns(
        {
            "AIC": dev + 2.0 * k,
            "SABIC": dev + k * F.log((n + 2.0) / 24.0),
            "HQ": dev + 2.0 * k * F.when(log_n > 0, F.log(log_n)),
            "BIC": dev + k * log_n,
        }
    )


def fit_table(models: list[FittedModel]) -> DataFrame:
    """One row per model."""
    table = models[0].fit
    for m in models[1:]:
        table = table.unionByName(m.fit)
    return fit_statistics(table).select(
        "model", "n_items", "npar", "n_respondents", "logLik", "AIC", "SABIC", "HQ", "BIC", "converged"
    )


@F.pandas_udf(DoubleType())
def _chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(a) or pd.isna(k) or k <= 0 else chi2_upper_tail(a, int(k)) for a, k in zip(x, df)],
        dtype="float64",
    )


def chi2_p(x: Column, df: Column) -> Column:
    return _chi2_tail(x.cast("double"), df.cast("double"))


def lrt_statistic(fit: DataFrame, small: str, big: str) -> DataFrame:
    """Chi-square and degrees of freedom of two nested models."""
    keys = ["logLik", "npar"]
    s = fit.filter(F.col("model") == small).select(F.lit(1).alias("_k"), *[F.col(c).alias(f"s_{c}") for c in keys])
    b = fit.filter(F.col("model") == big).select(F.lit(1).alias("_k"), *[F.col(c).alias(f"b_{c}") for c in keys])
    return s.join(b, "_k").select(
        F.lit(small).alias("small"), F.lit(big).alias("big"),
        (2.0 * (F.col("b_logLik") - F.col("s_logLik"))).alias("chi2"),
        (F.col("b_npar") - F.col("s_npar")).alias("df"),
    )


def lrt(fit: DataFrame, small: str, big: str) -> DataFrame:
    """Likelihood-ratio test with its p-value."""
    return lrt_statistic(fit, small, big).withColumn("p", chi2_p(F.col("chi2"), F.col("df")))


# ---- margins -------------------------------------------------------------

def item_pair_margins(resp: DataFrame) -> DataFrame:
    """Per pair of items: respondents who answered both, and who had both right."""
    items = item_list(resp)
    names = resp.sparkSession.createDataFrame([(i, q) for i, q in enumerate(items)], "i int, QID string")
    sums = pair_sums(pack_responses(resp, items), len(items)).filter("i < j")
    first = names.select("i", F.col("QID").alias("QID_1"))
    second = names.select(F.col("i").alias("j"), F.col("QID").alias("QID_2"))
    return sums.join(F.broadcast(first), "i").join(F.broadcast(second), "j").select(  # item-sized
        "QID_1", "QID_2", "n", "n_correct"
    )
