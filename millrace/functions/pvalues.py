"""Tail probabilities for t, F and chi-square, as Pandas UDFs.

They run on aggregated rows only (one per tested column pair).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of the incomplete beta."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 20000):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        step = 1.0
        for coef in (even, odd):
            d = 1.0 + coef * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + coef / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * math.exp(log_front))
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 20000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return math.exp(log_front) * h


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    if math.isinf(f):
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_upper(x: float, dof: float) -> float:
    return gamma_upper(dof / 2.0, x / 2.0)


def corr_two_sided(r: float, n: float) -> float:
    """p of a correlation coefficient through t with n - 2 degrees of freedom."""
    if n < 3:
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    return t_two_sided(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)


def _rowwise(fn, *series: pd.Series) -> pd.Series:
    def one(*args):
        return None if any(pd.isna(a) for a in args) else fn(*map(float, args))

    return pd.Series([one(*row) for row in zip(*series)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def corr_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return _rowwise(corr_two_sided, r, n)


@F.pandas_udf(T.DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _rowwise(f_upper, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _rowwise(chi2_upper, x, dof)
