"""Upper tail probabilities of the F and chi-square distributions, as logarithms.

Logarithms keep the order of probabilities that are too small for a double. Series and continued
fractions of the incomplete beta and gamma functions, for a handful of numbers per column on the driver.
"""

from __future__ import annotations

import math

PRECISION = 1e-14


def log_f_tail(f: float, d1: float, d2: float) -> float:
    """log P(F >= f) for d1 and d2 degrees of freedom; 0 where a degree is missing or f is not positive."""
    if not (f > 0 and d1 > 0 and d2 > 0):
        return 0.0
    if math.isinf(f):
        return -math.inf
    odds = d1 * f / d2
    log_x, log_y = -math.log1p(odds), -math.log1p(1 / odds)  # x + y = 1
    a, b = d2 / 2, d1 / 2
    log_front = a * log_x + b * log_y - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
    x = math.exp(log_x)
    if x < (a + 1) / (a + b + 2):
        return min(log_front - math.log(a) + math.log(_beta_fraction(x, a, b)), 0.0)
    other = math.exp(log_front) / b * _beta_fraction(math.exp(log_y), b, a)
    return math.log1p(-min(other, 1 - PRECISION))


def log_chi_square_tail(x: float, degrees: float) -> float:
    """log P(X >= x); 0 without degrees of freedom or where x is not positive."""
    if not (x > 0 and degrees > 0):
        return 0.0
    if math.isinf(x):
        return -math.inf
    a, h = degrees / 2, x / 2
    log_front = a * math.log(h) - h - math.lgamma(a)
    if h >= a + 1:
        return min(log_front + math.log(_gamma_fraction(h, a)), 0.0)
    term = total = 1 / a
    n = a
    while term > total * PRECISION:
        n += 1
        term *= h / n
        total += term
    return math.log1p(-min(math.exp(log_front) * total, 1 - PRECISION))


def _beta_fraction(x: float, a: float, b: float) -> float:
    """The continued fraction of the incomplete beta function, whose terms alternate between two forms."""

    def terms():
        m = 0
        while True:
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            m += 1
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    return 1 / _fraction(1.0, ((t, 1.0) for t in terms()))


def _gamma_fraction(h: float, a: float) -> float:
    def terms():
        i = 0
        while True:
            i += 1
            yield i * (a - i), h + 1 - a + 2 * i

    return 1 / _fraction(h + 1 - a, terms())


def _fraction(first: float, terms) -> float:
    """first + p1 / (q1 + p2 / (q2 + ...)) for terms (p, q), by the ratios of successive convergents."""
    tiny = 1e-300
    value = above = first or tiny
    below = 0.0
    for p, q in terms:
        below = 1 / ((q + p * below) or tiny)
        above = (q + p / above) or tiny
        step = above * below
        value *= step
        if abs(step - 1) < PRECISION:
            return value
