"""Tails of Student's t and Fisher's F by the regularised incomplete beta function."""

from __future__ import annotations

import math

TINY, STEPS, ENOUGH = 1e-300, 20_000, 1e-15


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, from the front, by ratios of
    neighbouring convergents."""
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), TINY)
    value = d
    for m in range(1, STEPS):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > TINY else TINY)
            c = 1.0 + top / c
            c = c if abs(c) > TINY else TINY
            value *= c * d
        if abs(c * d - 1.0) < ENOUGH:
            break
    return value


def beta_ratio(a: float, b: float, x: float, y: float | None = None) -> float:
    """I_x(a, b), the regularised incomplete beta function; ``y`` = 1 − x, if known without loss."""
    y = 1.0 - x if y is None else y
    if x <= 0.0 or y <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(y))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, y) / b


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) with ``df`` degrees of freedom; NaN where not defined."""
    if math.isnan(t) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    return beta_ratio(df / 2, 0.5, df / (df + t * t), t * t / (df + t * t))


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F >= f); NaN where not defined."""
    if math.isnan(f) or df1 <= 0 or df2 <= 0:
        return math.nan
    if math.isinf(f):
        return 0.0
    f = max(f, 0.0)
    return beta_ratio(df2 / 2, df1 / 2, df2 / (df2 + df1 * f), df1 * f / (df2 + df1 * f))


def normal_two_sided(z: float) -> float:
    return math.nan if math.isnan(z) else math.erfc(abs(z) / math.sqrt(2))
