"""Column expressions for numbers: null handling, moments, bins, row statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def dbl(name: str) -> Column:
    """The column as double with NaN turned into null."""
    return F.nanvl(col(name).cast("double"), F.lit(None).cast("double"))


def finite(name: str) -> Column:
    """The column as double with NaN and both infinities turned into null."""
    x = dbl(name)
    return F.when(F.abs(x) != F.lit(INF), x)


def safe_divide(num: Column, den: Column, default: float | None = None) -> Column:
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


# ---- moments: Spark's skewness / kurtosis are the population g1 / g2 ----------

def skew_sample(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness (G1) from g1 and the non-null count."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.greatest(n - 2, F.lit(1.0)))


def kurt_sample(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis (G2)."""
    n = n.cast("double")
    scale = (n - 1) / F.greatest((n - 2) * (n - 3), F.lit(1.0))
    return F.when(n > 3, scale * ((n + 1) * g2 + 6))


def skew_b1(g1: Column, n: Column) -> Column:
    """Mean cubed z-score with the ddof-1 deviation; 0 when undefined."""
    n = n.cast("double")
    ok = F.when(n > 2, g1 * F.pow((n - 1) / F.greatest(n, F.lit(1.0)), F.lit(1.5)))
    return F.coalesce(ok, F.lit(0.0))


def kurt_b2(g2: Column, n: Column) -> Column:
    """Mean fourth-power z-score with the ddof-1 deviation, minus 3; 0 when undefined."""
    n = n.cast("double")
    shrink = (n - 1) / F.greatest(n, F.lit(1.0))
    ok = F.when(n > 3, (g2 + 3) * shrink * shrink - 3)
    return F.coalesce(ok, F.lit(0.0))


def safe_corr(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson r; null (not an error) for constant input."""
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_pop(F.when(both, x))
    sy = F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)


def safe_slope(x: Column, y: Column) -> Column:
    """Least-squares slope of y on x over complete rows."""
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.var_pop(F.when(both, x)))


def equal_width_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based index of right-closed equal-width bins; the minimum is in bin 0."""
    if lo is None or hi is None:
        return F.lit(None).cast("int")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit((bins - 1) // 2))
    width = (hi - lo) / bins
    raw = F.ceil((x - F.lit(float(lo))) / F.lit(width)) - 1
    inside = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    return F.when(x.isNotNull(), inside)


def left_closed_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based index of left-closed bins; the maximum is in the last bin."""
    raw = F.floor((x - F.lit(float(lo))) / F.lit((hi - lo) / bins))
    return F.when(x.isNotNull(), F.least(raw, F.lit(bins - 1)).cast("int"))


# ---- statistics across the columns of one row ---------------------------------

def row_count(xs: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [x.isNotNull().cast("int") for x in xs])


def row_sum(xs: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0.0)) for x in xs])


def row_mean(xs: list[Column]) -> Column:
    return F.try_divide(row_sum(xs), row_count(xs).cast("double"))


def row_max(xs: list[Column]) -> Column:
    return F.greatest(*xs) if len(xs) > 1 else xs[0]


def row_min(xs: list[Column]) -> Column:
    return F.least(*xs) if len(xs) > 1 else xs[0]


def row_std(xs: list[Column]) -> Column:
    """Sample deviation across the non-null values of a row (two-pass form)."""
    mean = row_mean(xs)
    squares = row_sum([(x - mean) * (x - mean) for x in xs])
    return F.sqrt(F.try_divide(squares, (row_count(xs) - 1).cast("double")))
