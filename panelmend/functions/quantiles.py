"""Critical values used as literals on the driver: normal, chi-square and Student t."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

FALLBACK = 3.5


def clamp(alpha: float) -> float:
    return max(1e-10, min(alpha, 1.0 - 1e-10))


def normal_two_sided(alpha: float) -> float:
    """z with P(|Z| > z) = alpha."""
    try:
        return NormalDist().inv_cdf(1 - clamp(alpha) / 2)
    except (TypeError, ValueError):
        return FALLBACK


def _gamma_cdf(a: float, x: float) -> float:
    """Regularised lower incomplete gamma: series below the mode, continued fraction above."""
    if x <= 0:
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return scale * total
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1 - scale * h


def _beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_cdf(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1 / (1 + term * d)
            c = 1 + term / c
            h *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return front * h


def _bisect(cdf, p: float, hi: float) -> float:
    lo = 0.0
    while cdf(hi) < p:
        lo, hi = hi, hi * 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2


@lru_cache(maxsize=4096)
def chi2(p: float, df: float) -> float:
    return _bisect(lambda x: _gamma_cdf(df / 2, x / 2), p, df + 10.0)


@lru_cache(maxsize=65536)
def student_t_two_sided(alpha: float, nu: float) -> float:
    """t with P(|T| > t) = alpha."""
    return _bisect(lambda t: 1 - _beta_cdf(nu / 2, 0.5, nu / (nu + t * t)),
                   1 - clamp(alpha), 10.0)
