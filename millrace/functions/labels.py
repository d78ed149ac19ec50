"""Threshold tables turned into ``when`` chains.

Fixed values: the bands below are part of the results users compare, so they
are listed as plain (lower bound, label) pairs, highest first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRELATION_BANDS = [(0.80, "very strong"), (0.60, "strong"), (0.40, "moderate"), (0.20, "weak")]
ETA_BANDS = [(0.14, "strong"), (0.06, "moderate"), (0.01, "weak")]
CRAMERS_BANDS = [(0.50, "very strong"), (0.30, "strong"), (0.10, "moderate"), (0.05, "weak")]
REPORT_BANDS_WIDE = [(0.7, "strong"), (0.4, "moderate")]
REPORT_BANDS_NARROW = [(0.5, "strong"), (0.3, "moderate")]
STRENGTH_ORDER = ["very strong", "strong", "moderate", "weak", "very weak", "unknown"]


def band(x: Column, bands, below: str = "very weak") -> Column:
    out = F.when(x.isNull(), F.lit("unknown"))
    for bound, label in bands:
        out = out.when(x >= bound, F.lit(label))
    return out.otherwise(F.lit(below))


def strength_rank(label: Column) -> Column:
    pos = F.array_position(F.array(*[F.lit(s) for s in STRENGTH_ORDER]), label)
    return F.when(pos > 0, pos - 1).otherwise(len(STRENGTH_ORDER) - 1).cast("int")


def direction(r: Column) -> Column:
    return F.when(r > 0, F.lit("positive")).otherwise(F.lit("negative"))


def distribution(skew: Column, kurt: Column, n_unique: Column) -> Column:
    """Shape name from b1, b2 and the distinct count."""
    size = F.abs(skew)
    return (
        F.when(n_unique == 0, "unknown")
        .when(n_unique <= 2, "binary")
        .when(n_unique <= 10, "discrete-low-cardinality")
        .when((size < 0.5) & (F.abs(kurt) < 1.0), "normal")
        .when(skew > 1.0, "right-skewed")
        .when(skew < -1.0, "left-skewed")
        .when((kurt < -1.2) & (size < 0.5), "uniform")
        .when((kurt > 3.0) & (size < 0.5), "possibly-bimodal")
        .otherwise("moderate-skew")
    )


def distribution_by_tails(skew: Column, kurt: Column, sd: Column) -> Column:
    """Shape name that tells heavy from light tails."""
    size = F.abs(skew)
    flat = F.when(F.abs(kurt) < 0.5, "normal").when(kurt > 0, "leptokurtic").otherwise("platykurtic")
    return (
        F.when(sd < 0.01, "constant")
        .when(size < 0.5, flat)
        .when(skew > 1, "right_skewed")
        .when(skew < -1, "left_skewed")
        .otherwise("moderately_skewed")
    )


def missing_severity(pct: Column) -> Column:
    return F.when(pct > 20, "high").when(pct > 5, "medium").otherwise("low")


def overfit_risk(train: Column, test: Column, regression: bool = False) -> Column:
    gap = train - test
    high, medium = (0.20, 0.10) if regression else (0.15, 0.05)
    return F.when(gap > high, "high").when(gap > medium, "medium").otherwise("low")


def interpretation(kind: Column, strength: Column, effect: Column, p: Column) -> Column:
    """One sentence per tested pair."""
    verdict = F.when(p < 0.05, "statistically significant").otherwise("not significant")
    return F.format_string("%s %s: effect %.3f, p %.4f, %s", strength, kind, effect, p, verdict)
