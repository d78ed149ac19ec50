"""Outlier fences and treatments.  ``fit`` learns two bounds per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.clean import any_true
from millrace.operators.features import base_stats
from millrace.operators.quantiles import exact_quantiles
from millrace.plans.fitted import Step, applies

STRATEGIES = ["clip", "drop", "flag", "impute", "none"]
UNSUPPORTED = ["isolation_forest"]


def fit_outliers(
    df: DataFrame,
    cols: list[str] | None = None,
    method: str = "auto",
    strategy: str = "clip",
    iqr_factor: float = 1.5,
    z_limit: float = 3.0,
    skew_limit: float = 1.0,
    overrides: dict[str, dict[str, str]] | None = None,
    skip=(),
    min_values: int = 10,
    flag_suffix: str = "_is_outlier",
) -> Step:
    """method: iqr, zscore, both (the wider fence), auto (iqr when |G1| > limit).

    Two jobs: moments of all columns, quantiles of those that need them.
    """
    names = [c for c in (S.numeric_columns(df) if cols is None else cols) if c not in skip]
    overrides = overrides or {}
    stats = base_stats(df, names)
    names = [c for c in names if stats[c]["n"] >= min_values]
    chosen = {}
    for c in names:
        m = overrides.get(c, {}).get("method", method)
        if m in UNSUPPORTED:
            raise ValueError(f"outlier method {m!r} is not available")
        if m == "auto":
            m = "iqr" if abs(stats[c]["skew"] or 0.0) > skew_limit else "zscore"
        chosen[c] = m
    need = [c for c, m in chosen.items() if m != "zscore" or overrides.get(c, {}).get("strategy", strategy) == "impute"]
    quartiles = exact_quantiles(df, need, [0.25, 0.5, 0.75])
    plan = {}
    for c, m in chosen.items():
        s = stats[c]
        fences = []
        if m in ("iqr", "both"):
            q1, _, q3 = quartiles[c]
            fences.append((q1 - iqr_factor * (q3 - q1), q3 + iqr_factor * (q3 - q1)))
        if m in ("zscore", "both"):
            sd = s["sd"] or 0.0
            # no spread, no outlier: the fence is the whole range
            fences.append((s["mean"] - z_limit * sd, s["mean"] + z_limit * sd) if sd else (s["min"], s["max"]))
        plan[c] = {
            "method": m,
            "strategy": overrides.get(c, {}).get("strategy", strategy),
            "lower": min(f[0] for f in fences),
            "upper": max(f[1] for f in fences),
            "median": quartiles[c][1] if c in quartiles else None,
        }
    return Step("outliers", {"columns": plan, "suffix": flag_suffix})


def _mask(c, p):
    x = dbl(c)
    return F.coalesce((x < F.lit(p["lower"])) | (x > F.lit(p["upper"])), F.lit(False))


@applies("outliers")
def _apply_outliers(df, p):
    out, dropping = {}, []
    for c, f in p["columns"].items():
        if c not in df.columns:
            continue
        if f["strategy"] == "clip":
            x = dbl(c)
            out[c] = F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(f["upper"])), F.lit(f["lower"])))
        elif f["strategy"] == "flag":
            out[f"{c}{p['suffix']}"] = F.when(_mask(c, f), 1).otherwise(0)
        elif f["strategy"] == "impute":
            out[c] = F.when(_mask(c, f), F.lit(f["median"])).otherwise(dbl(c))
        elif f["strategy"] == "drop":
            dropping.append(_mask(c, f))
    if dropping:
        df = df.where(~any_true(dropping))
    return df.withColumns(out) if out else df


def outlier_report(df: DataFrame, step: Step) -> DataFrame:
    """(column, method, strategy, bounds, n, count, pct), counted in one job."""
    plan = step.params["columns"]
    if not plan:
        return df.sparkSession.createDataFrame([], _REPORT)
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(f["method"]).alias("method"),
            F.lit(f["strategy"]).alias("strategy"),
            F.lit(float(f["lower"])).alias("lower_bound"), F.lit(float(f["upper"])).alias("upper_bound"),
            F.count(col(c)).alias("n"), F.count_if(_mask(c, f)).alias("count"),
        )
        for c, f in plan.items()
    ]
    counted = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    pct = F.col("count") / F.greatest(F.col("n"), F.lit(1)) * 100
    return counted.withColumn("pct", pct)


_REPORT = (
    "`column` string, method string, strategy string, lower_bound double, upper_bound double, "
    "n bigint, `count` bigint, pct double"
)
