"""Quadrature grids, parameter layout and the item update shared by all models.

Everything here is item-sized: estimates and scalars are on the driver, item updates run in tasks on
blocks of items, and the respondents stay on Spark (``respan.irt.estep``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

ITEM_BLOCK = 256  # items updated together by one task


@dataclass(frozen=True)
class Grid:
    """Nodes of the general dimension and, for bifactor, of the specific one."""

    general: np.ndarray
    specific: np.ndarray | None = None
    sd: float = 1.0

    @property
    def log_prior(self) -> np.ndarray:
        return log_normal_weights(self.general, self.sd)

    @property
    def log_prior_specific(self) -> np.ndarray:
        return log_normal_weights(self.specific, 1.0)

    def design(self) -> np.ndarray:
        """One row per node: (theta, 1), or (g, u, 1) over the crossed grid."""
        if self.specific is None:
            return np.column_stack([self.general, np.ones_like(self.general)])
        g, u = np.meshgrid(self.general, self.specific, indexing="ij")
        return np.column_stack([g.ravel(), u.ravel(), np.ones(g.size)])


def log_normal_weights(nodes: np.ndarray, sd: float) -> np.ndarray:
    raw = -0.5 * (nodes / sd) ** 2
    return raw - np.logaddexp.reduce(raw)


def grid_1d(nodes: int = 61, limit: float = 6.0, sd: float = 1.0) -> Grid:
    return Grid(np.linspace(-limit, limit, nodes), sd=sd)


def grid_bifactor(nodes: int = 21, limit: float = 4.5) -> Grid:
    line = np.linspace(-limit, limit, nodes)
    return Grid(line, line)


@dataclass
class ModelState:
    """Current estimates.  ``coef`` has one row per item, columns as in ``Grid.design``."""

    kind: str
    items: list[str]
    grid: Grid
    coef: np.ndarray
    free: np.ndarray
    factor: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=int))  # 0 = general only

    @property
    def npar(self) -> int:
        return int(self.free.sum()) + (1 if self.kind == "rasch" else 0)


def start_state(kind: str, items: list[str], factor: dict[str, int] | None = None, grid: Grid | None = None) -> ModelState:
    n = len(items)
    if kind in ("rasch", "2pl"):
        coef = np.tile([1.0, 0.0], (n, 1))
        free = np.tile([kind == "2pl", True], (n, 1))
        return ModelState(kind, items, grid or grid_1d(), coef, free)
    if kind != "bifactor":
        raise ValueError(f"unknown model {kind!r}")
    which = np.array([(factor or {}).get(q, 0) for q in items], dtype=int)
    coef = np.tile([1.0, 0.5, 0.0], (n, 1))
    coef[which == 0, 1] = 0.0
    free = np.column_stack([np.ones(n, bool), which > 0, np.ones(n, bool)])
    return ModelState(kind, items, grid or grid_bifactor(), coef, free, which)


def _objective(eta: np.ndarray, n: np.ndarray, r: np.ndarray) -> np.ndarray:
    return (r * eta - n * np.logaddexp(0.0, eta)).sum(axis=1)


def update_items(
    coef: np.ndarray, free: np.ndarray, design: np.ndarray, n: np.ndarray, r: np.ndarray, steps: int = 20,
    slope_bound: float | None = None,
) -> np.ndarray:
    """Weighted logistic fit of every item by Newton steps with halving.

    ``n`` and ``r`` (items x nodes) are the expected answers and correct answers.  A step
    that lowers an item's expected log-likelihood is halved, so it never falls.  Slopes are
    kept within ``slope_bound`` if one is given.
    """
    coef = coef.copy()
    p = design.shape[1]
    eye = np.eye(p)
    fixed = np.where(free, 0.0, 1.0)
    value = _objective(coef @ design.T, n, r)
    for _ in range(steps):
        prob = 1.0 / (1.0 + np.exp(-(coef @ design.T)))
        grad = ((r - n * prob) @ design) * free
        weight = n * prob * (1.0 - prob)
        hess = np.einsum("iq,qa,qb->iab", weight, design, design, optimize=True)
        hess = hess * free[:, :, None] * free[:, None, :] + eye * (fixed[:, :, None] + 1e-9)
        step = np.linalg.solve(hess, grad[:, :, None])[:, :, 0]
        scale = np.ones(len(coef))
        for _ in range(12):
            trial = coef + scale[:, None] * step
            if slope_bound is not None:
                trial[:, :-1] = np.clip(trial[:, :-1], -slope_bound, slope_bound)
            trial_value = _objective(trial @ design.T, n, r)
            worse = trial_value < value - 1e-12 * np.abs(value)
            if not worse.any():
                break
            scale[worse] *= 0.5
        trial = np.where(worse[:, None], coef, trial)
        moved = np.abs(trial - coef).max()
        coef, value = trial, np.where(worse, value, trial_value)
        if moved < 1e-8:
            break
    return coef
