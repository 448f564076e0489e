"""Limited-information goodness of fit (M2) from univariate and bivariate margins.

The covariance of the margins is never built.  Given the latent variables the items are independent, so
the covariance acts on a vector of margins in closed form at each node of the grid; the quadratic form
is then one conjugate-gradient solve over items x items tables.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from respan.irt.chi2 import chi2_upper_tail
from respan.irt.estep import pair_sums
from respan.irt.fit import FittedModel, PackedResponses, _as_state, fit_statistics, packed_for
from respan.irt.model import ModelState
from respan.operators.rows import stack

STAT_NAMES = ("M2", "df_M2", "p_M2", "RMSEA_M2", "SRMSR_M2", "TLI_M2", "CFI_M2")
_DDL = "M2 double, df_M2 double, p_M2 double, RMSEA_M2 double, SRMSR_M2 double, TLI_M2 double, CFI_M2 double, reason string"


class Margins:
    """Moments of the items under a model.  A vector of margins is (singles, symmetric table of pairs).

    Given the general variable, items of different groups are independent; a group is one item, or the
    items of one specific factor, whose joint moments are sums over that factor's nodes.
    """

    def __init__(self, state: ModelState):
        self.state, n = state, len(state.items)
        self.weight = np.exp(state.grid.log_prior)
        design = state.grid.design()
        prob = 1.0 / (1.0 + np.exp(-(state.coef @ design.T)))
        slope = prob * (1.0 - prob)
        if state.kind != "bifactor":
            self.mean = prob.T  # general nodes x items
            self.derivative = np.einsum("iq,qk->qik", slope, design)
            self.groups: list[np.ndarray] = []
        else:
            u = np.exp(state.grid.log_prior_specific)
            shape = (n, len(self.weight), len(u))
            self.mean = (prob.reshape(shape) @ u).T
            inside = (slope[:, :, None] * design[None]).reshape(*shape, design.shape[1])
            self.derivative = np.einsum("igvk,v->gik", inside, u)
            self.groups = [np.flatnonzero(state.factor == t) for t in np.unique(state.factor) if t and (state.factor == t).sum() > 1]
        self.variance = self.mean * (1.0 - self.mean)
        # per group: values of its singles and pairs at each (general, specific) node
        self.pairs, self.values, self.cross = [], [], []
        for items in self.groups:
            i, j = np.triu_indices(len(items), 1)
            y = prob.reshape(shape)[items]
            singles, both = y, y[i] * y[j]
            self.pairs.append((items[i], items[j]))
            self.values.append(np.concatenate([singles, both]))
            self.cross.append((inside[items], y, u))
        self.second = [self._second(k) for k in range(len(self.groups))]
        self.single = self.weight @ self.mean
        self.pair = np.einsum("g,gi,gj->ij", self.weight, self.mean, self.mean)
        for (i, j), m, items in zip(self.pairs, self.values, self.groups):
            self.pair[i, j] = self.pair[j, i] = np.einsum("g,pg->p", self.weight, m[len(items) :] @ u)

    def _second(self, k: int) -> np.ndarray:
        """Covariances of a group's singles and pairs given the general variable (nodes x functions x functions)."""
        items = self.groups[k]
        i, j = np.triu_indices(len(items), 1)
        members = [{a} for a in range(len(items))] + [{a, b} for a, b in zip(i, j)]
        _, y, u = self.cross[k]
        known: dict[frozenset, np.ndarray] = {}

        def moment(which: frozenset) -> np.ndarray:
            if which not in known:
                known[which] = np.prod([y[a] for a in which], axis=0) @ u
            return known[which]

        mean = self.values[k] @ u
        size = len(members)
        out = np.empty((len(self.weight), size, size))
        for a in range(size):
            for b in range(a, size):
                out[:, a, b] = out[:, b, a] = moment(frozenset(members[a] | members[b])) - mean[a] * mean[b]
        return out

    def covariance(self, v: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The covariance of all margins times the vector (v, table)."""
        out_v, out_t = np.zeros_like(v), np.zeros_like(table)
        total = 0.0
        grouped = np.zeros_like(table, bool)
        for i, j in self.pairs:
            grouped[i, j] = grouped[j, i] = True
        outside = np.where(grouped, 0.0, table)
        for g, w in enumerate(self.weight):
            p = self.mean[g]
            lift = v + outside @ p  # weight of an item's deviation, pairs with other groups included
            single = self.variance[g] * lift
            block = np.diag(self.variance[g])
            conditional = float(v @ p + 0.5 * p @ outside @ p)
            within = []
            for (i, j), second, values, items, (_, _, u) in zip(self.pairs, self.second, self.values, self.groups, self.cross):
                moved = second[g] @ np.concatenate([lift[items], table[i, j]])
                single[items] = moved[: len(items)]
                block[np.ix_(items, items)] = second[g][: len(items), : len(items)]
                mean = values[len(items) :, g] @ u
                conditional += float(table[i, j] @ mean)
                within.append((i, j, moved[len(items) :], mean))
            crossed = np.outer(single, p)
            pairs = crossed + crossed.T + block @ outside @ block
            means = np.outer(p, p)
            for i, j, moved, mean in within:
                pairs[i, j] = pairs[j, i] = moved
                means[i, j] = means[j, i] = mean
            out_v += w * (single + p * conditional)
            out_t += w * (pairs + means * conditional)
            total += w * conditional
        out_v -= self.single * total
        out_t -= self.pair * total
        np.fill_diagonal(out_t, 0.0)
        return out_v, out_t

    def jacobian(self) -> np.ndarray:
        """Derivatives of the margins (singles, then pairs i < j) by every free parameter."""
        state, n = self.state, len(self.state.items)
        i, j = np.triu_indices(n, 1)
        columns = []
        group_of = {a: k for k, items in enumerate(self.groups) for a in items}
        for a, k in zip(*np.nonzero(state.free)):
            d = self.derivative[:, a, k]
            row = np.einsum("g,g,gi->i", self.weight, d, self.mean)
            if a in group_of:
                items = self.groups[group_of[a]]
                inside, y, u = self.cross[group_of[a]]
                own = int(np.flatnonzero(items == a)[0])
                row[items] = np.einsum("g,gv,igv,v->i", self.weight, inside[own, :, :, k], y, u)
            pair = np.zeros(len(i))
            pair[i == a], pair[j == a] = row[j[i == a]], row[i[j == a]]
            single = np.zeros(n)
            single[a] = self.weight @ d
            columns.append(np.concatenate([single, pair]))
        if state.kind == "rasch":
            step, sides = 1e-5, []
            for sign in (1.0, -1.0):
                grid = type(state.grid)(state.grid.general, sd=state.grid.sd + sign * step)
                w = np.exp(grid.log_prior)
                sides.append(np.concatenate([w @ self.mean, np.einsum("g,gi,gj->ij", w, self.mean, self.mean)[i, j]]))
            columns.append((sides[0] - sides[1]) / (2 * step))
        return np.column_stack(columns)


def quadratic_form(observed: np.ndarray, n: int, state: ModelState, tol: float = 1e-8) -> dict:
    """M2, its df and the residual SRMSR, for complete data.

    ``observed`` is the items x items table of shares of respondents with both items right (the diagonal
    holds the single items).  With residuals r, margins' covariance C and derivatives D, M2 is
    n * r' x, x the solution of C x = r among the vectors orthogonal to D.
    """
    m, size = Margins(state), len(state.items)
    i, j = np.triu_indices(size, 1)
    delta = m.jacobian()
    basis = np.linalg.svd(delta, full_matrices=False)
    basis = basis[0][:, basis[1] > 1e-10 * basis[1][0]]
    project = lambda x: x - basis @ (basis.T @ x)

    def act(x: np.ndarray) -> np.ndarray:
        table = np.zeros((size, size))
        table[i, j] = table[j, i] = x[size:]
        v, t = m.covariance(x[:size], table)
        return project(np.concatenate([v, t[i, j]]))

    seen = np.concatenate([np.diag(observed), observed[i, j]])
    expected = np.concatenate([m.single, m.pair[i, j]])
    start = project(seen - expected)
    x, left = np.zeros_like(start), start.copy()
    towards, power = left.copy(), float(left @ left)
    for _ in range(20 * len(start)):
        if power <= tol**2 * float(start @ start) or power == 0.0:
            break
        moved = act(towards)
        step = power / float(towards @ moved)
        x, left = x + step * towards, left - step * moved
        towards, power = left + (float(left @ left) / power) * towards, float(left @ left)
    else:
        raise np.linalg.LinAlgError("the solve for M2 did not converge")
    return {"M2": float(n * (start @ x)), "df": len(seen) - delta.shape[1], "SRMSR": _srmsr(observed, m.single, m.pair)}


def _srmsr(observed: np.ndarray, single: np.ndarray, pair: np.ndarray) -> float:
    def corr(p, both):
        sd = np.sqrt(p * (1.0 - p))
        return (both - np.outer(p, p)) / np.outer(sd, sd)

    gaps = corr(np.diag(observed), observed) - corr(single, pair)
    return float(np.sqrt(np.mean(np.square(gaps[np.triu_indices(len(single), 1)]))))


def _independence_form(observed: np.ndarray, n: int) -> tuple[float, int]:
    """M2 and df of the model without any dependence between items."""
    p = np.diag(observed)
    v = p * (1.0 - p)
    terms = (observed - np.outer(p, p)) ** 2 / np.outer(v, v)
    return float(n * terms[np.triu_indices(len(p), 1)].sum()), len(p) * (len(p) - 1) // 2


def _compute(both: np.ndarray, right: np.ndarray, state: ModelState) -> tuple:
    n = int(both[0, 0])
    n_margins = len(state.items) * (len(state.items) + 1) // 2
    if not np.all(both == n):
        return (*[None] * 7, "missing responses: margins do not share one sample")
    df = n_margins - state.npar
    if df <= 0:
        return (*[None] * 7, "no degrees of freedom")
    observed = right / n
    try:
        fit = quadratic_form(observed, n, state)
        base, base_df = _independence_form(observed, n)
    except np.linalg.LinAlgError as e:
        return (*[None] * 7, f"not computable: {e}")
    m2 = fit["M2"]
    rmsea = math.sqrt(max(0.0, (m2 - df) / (df * (n - 1))))
    tli = ((base / base_df) - (m2 / df)) / ((base / base_df) - 1.0)
    cfi = 1.0 - max(m2 - df, 0.0) / max(base - base_df, m2 - df, 1e-300)
    values = (m2, df, chi2_upper_tail(m2, df), rmsea, fit["SRMSR"], tli, cfi)
    return (*[float(v) for v in values], None)


def m2_stats(resp: DataFrame | PackedResponses, model: FittedModel | ModelState) -> DataFrame:
    """One row: M2, df, p, RMSEA, SRMSR, TLI, CFI, or nulls and the reason.

    Spark sums the margins over the respondents; what comes back is items x items.
    """
    state = _as_state(model)
    n_items = len(state.items)
    packed = packed_for(resp, state.items)
    spark = packed.sparkSession
    table = pair_sums(packed, n_items).toArrow()
    both, right = np.zeros((n_items, n_items)), np.zeros((n_items, n_items))
    i, j = table["i"].to_numpy(), table["j"].to_numpy()
    both[i, j] = both[j, i] = table["n"].to_numpy()
    right[i, j] = right[j, i] = table["n_correct"].to_numpy()
    return spark.createDataFrame([_compute(both, right, state)], _DDL)


def model_stats(resp: DataFrame | PackedResponses, models: list[FittedModel]) -> DataFrame:
    """Fit statistics and M2 of several models, one row per model."""
    parts = []
    for m in models:
        stats = m2_stats(resp, m).withColumn("model", F.lit(m.name))
        parts.append(fit_statistics(m.fit).join(stats, "model"))
    return stack(*parts).select(
        "model", "npar", "logLik", "AIC", "BIC", "SABIC", "converged", *STAT_NAMES, "reason"
    )
