"""Eigendecomposition kept up to date under rank-one changes.

A symmetric matrix is held as ``vectors @ diag(values) @ vectors.T`` with ascending values.  Adding
``rho * v v^T`` moves the values to the roots of a secular equation, one between any two neighbours; all
roots are iterated together.  Directions that ``v`` misses, and all but one of equal values, are deflated:
they keep their value.  The weights are recomputed from the roots before the vectors are formed, so that
the vectors are orthogonal however close roots lie.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_EPS = np.finfo(float).eps


class Spectrum(NamedTuple):
    """Scatter of ``n`` integer vectors of sum ``total`` around their mean."""

    n: int
    total: np.ndarray  # int64
    values: np.ndarray
    vectors: np.ndarray


def empty(dim: int) -> Spectrum:
    return Spectrum(0, np.zeros(dim, np.int64), np.zeros(dim), np.eye(dim))


def _roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """``d_i - root_j`` for the roots of 1 + sum z2_i / (d_i - x) = 0; ``d`` strictly ascending, ``z2`` positive."""
    m = len(d)
    j = np.arange(m)
    upper = np.append(d[1:], d[-1] + z2.sum() * (1 + 4 * _EPS))
    half = (upper - d) / 2
    at_half = 1 + (z2[:, None] / (d[:, None] - (d + half)[None, :])).sum(0)
    right = (at_half < 0) & (j < m - 1)  # the root is nearer to the pole above
    pole = np.where(right, j + 1, j)
    delta = d[:, None] - d[pole][None, :]
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, np.where((j < m - 1) | (at_half >= 0), half, upper - d))
    low = np.where((j == m - 1) & (at_half < 0), half, low)
    tau = (low + high) / 2
    below = (j[:, None] <= j[None, :]).astype(float)
    beyond = 1 - below
    column_sums = "ij,ij->j"
    above = np.minimum(j + 1, m - 1)
    for _ in range(100):
        gap = delta - tau
        term = z2[:, None] / gap
        slope = term / gap
        psi, dpsi = np.einsum(column_sums, term, below), np.einsum(column_sums, slope, below)
        phi, dphi = np.einsum(column_sums, term, beyond), np.einsum(column_sums, slope, beyond)
        f = 1 + psi + phi
        low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
        done = (np.abs(f) <= 8 * _EPS * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        g, h = gap[j, j], gap[above, j]
        # psi and phi replaced by one pole each, with their value and slope here
        c = 1 + psi - g * dpsi + np.where(j < m - 1, phi - h * dphi, 0)
        s, t = g * g * dpsi, np.where(j < m - 1, h * h * dphi, 0)
        h = np.where(j < m - 1, h, 1.0)
        a = np.where(j < m - 1, c * (g + h) + s + t, 0)
        b = g * h * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(j < m - 1, step, g + s / c)
            new = tau + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return delta - tau


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors after adding ``rho * v v^T``; ``rho`` is not negative."""
    z = vectors.T @ v
    size = float(z @ z)
    if rho <= 0 or size == 0:
        return values, vectors
    tol = 8 * _EPS * max(abs(values[0]), abs(values[-1]), rho * size)
    close = np.diff(values) <= tol
    if close.any():  # of equal values one takes the whole weight of the group
        z, vectors = z.copy(), vectors.copy()
        values = values.copy()
        edges = np.flatnonzero(~close) + 1
        for group in np.split(np.arange(len(values)), edges):
            while len(group) > 1:
                part = group[values[group] <= values[group[0]] + tol]
                norm = np.sqrt(z[part] @ z[part])
                if len(part) > 1 and norm > 0:
                    w = z[part].copy()
                    w[-1] += norm if w[-1] >= 0 else -norm
                    w /= np.sqrt(w @ w)
                    vectors[:, part] -= 2 * np.outer(vectors[:, part] @ w, w)
                    last = -norm if z[part[-1]] >= 0 else norm
                    z[part] = 0
                    z[part[-1]] = last
                group = group[len(part) :]
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) * rho > tol)
    if not len(live):
        return values, vectors
    d, w = values[live], z[live]
    if len(live) == 1:
        new, turned = d + rho * w * w, vectors[:, live]
    else:
        gap = _roots(d, rho * w * w)  # d_i - root_j
        apart = d[:, None] - d[None, :]
        np.fill_diagonal(apart, 1.0)
        weight = np.sqrt(np.abs(np.prod(gap / apart, axis=1)))
        u = (np.copysign(weight, w))[:, None] / gap
        u /= np.sqrt((u * u).sum(0))
        turned = vectors[:, live] @ u
        new = d - np.diagonal(gap)
    values, vectors = values.copy(), vectors.copy()
    values[live], vectors[:, live] = new, turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def add(s: Spectrum, x: np.ndarray, times: int = 1) -> Spectrum:
    """``times`` rows equal to ``x`` more: a centred change of rank one."""
    n = s.n + times
    values, vectors = s.values, s.vectors
    if s.n:
        values, vectors = rank_one(values, vectors, x - s.total / s.n, s.n * times / n)
    return Spectrum(n, s.total + times * x, values, vectors)


def combine(a: Spectrum, b: Spectrum) -> Spectrum:
    """The spectrum of the rows of both: b's directions enter a one after another, then the step between the means."""
    if not a.n or not b.n:
        return a if a.n else b
    values, vectors = a.values, a.vectors
    for value, v in zip(b.values, b.vectors.T):
        values, vectors = rank_one(values, vectors, v, float(value))
    n = a.n + b.n
    values, vectors = rank_one(values, vectors, a.total / a.n - b.total / b.n, a.n / n * b.n)
    return Spectrum(n, a.total + b.total, values, vectors)
