"""Tail probabilities used by the tests on already reduced (k x k) statistics."""

from __future__ import annotations

import math

_EPS = 1e-15
_TINY = 1e-300


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def _continued_fraction(a_term, b_term, limit: int = 10000) -> float:
    """Lentz evaluation of b0 + a1/(b1 + a2/(b2 + ...))."""
    f = b_term(0) or _TINY
    c, d = f, 0.0
    for i in range(1, limit):
        d = b_term(i) + a_term(i) * d
        c = b_term(i) + a_term(i) / c
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = c if abs(c) > _TINY else _TINY
        step = c * d
        f *= step
        if abs(step - 1.0) < _EPS:
            break
    return f


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_cdf(1.0 - x, b, a)
    front = math.exp(
        a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    ) / a

    def numerator(i: int) -> float:
        if i == 1:
            return 1.0
        m, odd = divmod(i - 1, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    return front * _continued_fraction(numerator, lambda i: 0.0 if i == 0 else 1.0)


def gamma_sf(x: float, a: float) -> float:
    """Upper regularised incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - front * total
    return front / _continued_fraction(lambda i: i * (a - i), lambda i: x + 2 * i + 1 - a, 10000)


def f_sf(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_cdf(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0)


def chi2_sf(x: float, df: float) -> float:
    return gamma_sf(x / 2.0, df / 2.0)


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / (df + t * t), df / 2.0, 0.5)


# Published response-surface coefficients (MacKinnon 1994, 2010), constant, one series.
_TAU_MAX = 2.74
_TAU_MIN = -18.83
_TAU_STAR = -1.61
_SMALL_P = (2.1659, 1.4412, 0.038269)
_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def mackinnon_p(stat: float) -> float:
    """Unit-root test p-value for a regression with a constant."""
    if stat > _TAU_MAX:
        return 1.0
    if stat < _TAU_MIN:
        return 0.0
    coefficients = _SMALL_P if stat <= _TAU_STAR else _LARGE_P
    return normal_cdf(sum(c * stat**i for i, c in enumerate(coefficients)))


def mackinnon_critical(nobs: int) -> dict[str, float]:
    return {level: sum(c / nobs**i for i, c in enumerate(cs)) for level, cs in _CRITICAL.items()}
