"""Tail probabilities of single test statistics (one scalar each, evaluated on the driver)."""

from __future__ import annotations

import math

_TINY = 1e-300
_EPS = 1e-15


def _lentz(terms, first: float) -> float:
    """Value of the continued fraction first + a1/(1 + ...) given (a, b) terms (modified Lentz)."""
    value = first or _TINY
    c, d = value, 0.0
    for a, b in terms:
        d = b + a * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + a / (c if abs(c) > _TINY else _TINY)
        step = c * d
        value *= step
        if abs(step - 1.0) < _EPS:
            break
    return value


def regularized_beta(x: float, a: float, b: float) -> float:
    """I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - regularized_beta(1.0 - x, b, a)

    def terms():
        yield 1.0, 1.0
        for m in range(1, 100_000):
            # odd, then even coefficient of the standard expansion
            k = m - 1
            yield -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1)), 1.0
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) / a * _lentz(terms(), 0.0)


def f_tail(f: float, dof_between: float, dof_within: float) -> float:
    """P(F >= f)."""
    if math.isnan(f):
        return math.nan
    if f <= 0.0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return regularized_beta(dof_within / (dof_within + dof_between * f), dof_within / 2, dof_between / 2)


def chi_square_tail(x: float, dof: float) -> float:
    """P(X >= x) for a chi-square variable."""
    if x <= 0.0:
        return 1.0
    a, half = dof / 2.0, x / 2.0
    log_front = a * math.log(half) - half - math.lgamma(a)
    if half < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1.0
            term *= half / n
            total += term
        return 1.0 - total * math.exp(log_front)

    def terms():
        yield 1.0, half + 1.0 - a
        for i in range(1, 100_000):
            yield -i * (i - a), half + 2 * i + 1.0 - a

    return math.exp(log_front) * _lentz(terms(), 0.0)
