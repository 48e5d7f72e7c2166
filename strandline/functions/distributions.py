"""Tail probabilities and quantiles for rows that are already aggregated; plain Python over single numbers."""

from __future__ import annotations

import math


def normal_sf2(z: float) -> float:
    """Two-sided p of a standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def gamma_sf(a: float, x: float) -> float:
    """Upper regularized incomplete gamma, by series below a + 1 and by continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1 - total * front
    tiny = 1e-300
    b, c = x + 1 - a, 1 / tiny
    d = h = 1 / b
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * front


def chi2_sf(x: float, df: float) -> float:
    return gamma_sf(df / 2, x / 2)


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + num * d) or tiny)
            c = (1 + num / c) or tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def t_sf2(t: float, df: float) -> float:
    """Two-sided p of Student's t."""
    return beta_cdf(df / 2, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    return beta_cdf(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def quantile(cdf, p: float, low: float, high: float) -> float:
    """By bisection of a rising function."""
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return (low + high) / 2


def binomial_exact(x: int, n: int, alpha: float = 0.05) -> tuple[float, float]:
    """Clopper-Pearson bounds."""
    low = 0.0 if x == 0 else quantile(lambda p: beta_cdf(x, n - x + 1, p), alpha / 2, 0, 1)
    high = 1.0 if x == n else quantile(lambda p: beta_cdf(x + 1, n - x, p), 1 - alpha / 2, 0, 1)
    return low, high


def poisson_exact(x: int, alpha: float = 0.05) -> tuple[float, float]:
    """Garwood bounds of a count."""
    top = 2 * x + 50 + 10 * math.sqrt(x + 1)
    low = 0.0 if x == 0 else quantile(lambda m: 1 - gamma_sf(x, m), alpha / 2, 0, top)
    return low, quantile(lambda m: 1 - gamma_sf(x + 1, m), 1 - alpha / 2, 0, top)
