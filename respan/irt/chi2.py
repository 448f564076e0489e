"""Upper tail of the chi-square distribution (regularised incomplete gamma function)."""

from __future__ import annotations

import math


def chi2_upper_tail(x: float, df: int) -> float:
    if x <= 0:
        return 1.0
    a, z = df / 2.0, x / 2.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a)) if z < 700 + a else 0.0
    if z < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > 1e-16 * abs(total):
            n += 1.0
            term *= z / n
            total += term
        return max(0.0, 1.0 - front * total)
    # continued fraction for the upper part, evaluated from the front
    tiny = 1e-300
    b = z + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    frac = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2.0
        d = step * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + step / c
        c = c if abs(c) > tiny else tiny
        frac *= d * c
        if abs(d * c - 1.0) < 1e-15:
            return front * frac
    raise ArithmeticError(f"no convergence for chi-square {x} on {df} degrees of freedom")
