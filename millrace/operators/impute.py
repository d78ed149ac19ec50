"""Missing values: fitted fills, and order-aware fills inside an entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.features import base_stats
from millrace.operators.quantiles import exact_quantiles, modes
from millrace.operators.skew import fill_nearest, with_row_number
from millrace.plans.fitted import Step, applies

# Fixed names of constant strategies.
CONSTANTS = {"unknown": "Unknown", "zero": 0, "false": False}


@applies("fill")
def _apply_fill(df, p):
    out = {}
    for c, v in p["values"].items():
        if c not in df.columns or v is None:
            continue
        kind = df.schema[c].dataType
        if isinstance(kind, T.NumericType):
            # a fractional fill widens an integer column
            if not isinstance(kind, (T.DoubleType, T.FloatType)) and float(v) == int(v):
                out[c] = F.coalesce(col(c), F.lit(int(v)).cast(kind))
            else:
                out[c] = F.coalesce(dbl(c), F.lit(float(v)))
        else:
            out[c] = F.coalesce(col(c), F.lit(v).cast(kind))
    done = df.withColumns(out) if out else df
    drop = [c for c in p.get("drop_rows", []) if c in df.columns]
    return done.na.drop(subset=drop) if drop else done


def _means(df, cols):
    if not cols:
        return {}
    row = df.agg(*[F.avg(dbl(c)).alias(f"m{i}") for i, c in enumerate(cols)]).head()
    return {c: row[i] if row[i] is not None else 0.0 for i, c in enumerate(cols)}


def _medians(df, cols):
    return {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items()}


def _modes(df, cols):
    """Smallest most frequent value per column, typed like the column."""
    out = {}
    numbers = [c for c in cols if c in S.numeric_columns(df)]
    others = [c for c in cols if c not in numbers]
    for group, kind in ((numbers, "double"), (others, "string")):
        if group:
            out.update({r["column"]: r["mode"] for r in modes(df, group, kind).collect()})
    return out


def fit_impute(df: DataFrame, strategies: dict[str, str]) -> Step:
    """Per-column strategy: mean, median, mode, unknown, zero, false,
    const:<v> / constant:<v>, drop_rows, skip.  One job per family of
    strategies, however many columns."""
    by: dict[str, list[str]] = {}
    values: dict[str, object] = {}
    for c, s in strategies.items():
        if c not in df.columns:
            continue
        if s in CONSTANTS:
            values[c] = CONSTANTS[s]
        elif s.startswith(("const:", "constant:")):
            values[c] = s.split(":", 1)[1]
        elif s in ("mean", "median", "mode", "drop_rows"):
            by.setdefault(s, []).append(c)
        elif s != "skip":
            raise ValueError(f"unknown fill strategy {s!r} for column {c!r}")
    values.update(_means(df, by.get("mean", [])))
    values.update(_medians(df, by.get("median", [])))
    values.update(_modes(df, by.get("mode", [])))
    return Step("fill", {"values": values, "drop_rows": by.get("drop_rows", [])})


def auto_by_family(df: DataFrame) -> dict[str, str]:
    """Numeric median, boolean mode, everything else Unknown.

    Time columns need an order key for a forward fill; see ``fill_by_family``."""
    out = {c: "median" for c in S.numeric_columns(df)}
    out.update({c: "mode" for c in S.boolean_columns(df)})
    out.update({c: "unknown" for c in S.text_columns(df)})
    return out


def auto_by_skew(df: DataFrame, limit: float = 1.0) -> dict[str, str]:
    """Numeric mean, or median when |G1| exceeds the limit; others the mode."""
    numbers = S.numeric_columns(df)
    stats = base_stats(df, numbers)
    out = {c: "median" if abs(stats[c]["skew"] or 0.0) > limit else "mean" for c in numbers}
    out.update({c: "mode" for c in S.text_columns(df) + S.boolean_columns(df)})
    return out


def auto_by_table(df: DataFrame) -> dict[str, str]:
    """Median everywhere when most columns are numeric, else the mode."""
    numbers = S.numeric_columns(df)
    mostly = len(numbers) > len(df.columns) / 2
    return {
        c: "median" if mostly and c in numbers else "mode"
        for c in df.columns
        if c not in S.time_columns(df)
    }


def fit_impute_auto(df: DataFrame, rule: str = "skew", overrides: dict[str, str] | None = None, skip=()) -> Step:
    plan = {"skew": auto_by_skew, "family": auto_by_family, "table": auto_by_table}[rule](df)
    plan.update(overrides or {})
    return fit_impute(df, {c: s for c, s in plan.items() if c not in skip})


# ---- order-aware fills --------------------------------------------------------

def ffill(df: DataFrame, columns: list[str], order_by: list[str], partition_by: list[str] = (), head: bool = True) -> DataFrame:
    """Last seen value; with ``head`` the leading gap takes the next value."""
    wanted = {f"__b_{c}": (col(c), "before") for c in columns}
    if head:
        wanted.update({f"__a_{c}": (col(c), "after") for c in columns})
    out = fill_nearest(df, wanted, order_by, partition_by)
    pick = {c: F.coalesce(f"__b_{c}", f"__a_{c}") if head else F.col(f"__b_{c}") for c in columns}
    return out.withColumns(pick).drop(*wanted)


def fill_by_family(
    df: DataFrame, order_by: list[str], partition_by: list[str] = (), skip=(), overrides: dict[str, str] | None = None, head: bool = True,
) -> DataFrame:
    """The family rule with its forward fill of time columns (see ``ffill``).

    Order and partition columns are keys and stay as they are."""
    keys = {*order_by, *partition_by, *skip}
    step = fit_impute_auto(df, "family", overrides, keys)
    times = [c for c in S.time_columns(df) if c not in keys and c not in (overrides or {})]
    return step.transform(ffill(df, times, order_by, partition_by, head) if times else df)


def bfill(df: DataFrame, columns: list[str], order_by: list[str], partition_by: list[str] = (), tail: bool = True) -> DataFrame:
    """Next seen value; with ``tail`` the trailing gap takes the last value."""
    wanted = {f"__a_{c}": (col(c), "after") for c in columns}
    if tail:
        wanted.update({f"__b_{c}": (col(c), "before") for c in columns})
    out = fill_nearest(df, wanted, order_by, partition_by)
    pick = {c: F.coalesce(f"__a_{c}", f"__b_{c}") if tail else F.col(f"__a_{c}") for c in columns}
    return out.withColumns(pick).drop(*wanted)


def interpolate(df: DataFrame, columns: list[str], order_by: list[str], partition_by: list[str] = ()) -> DataFrame:
    """Linear by row position; the tail keeps the last value, the head stays null."""
    out = with_row_number(df, order_by, partition_by, "__rn")
    wanted = {}
    for c in columns:
        point = F.when(col(c).isNotNull(), F.struct(F.col("__rn").alias("rn"), dbl(c).alias("v")))
        wanted[f"__b_{c}"] = (point, "before")
        wanted[f"__a_{c}"] = (point, "after")
    # the position is unique within the entity, so it is the whole order key
    out = fill_nearest(out, wanted, ["__rn"], partition_by)
    pick = {}
    for c in columns:
        b, a = F.col(f"__b_{c}"), F.col(f"__a_{c}")
        share = F.try_divide((F.col("__rn") - b["rn"]).cast("double"), (a["rn"] - b["rn"]).cast("double"))
        line = b["v"] + (a["v"] - b["v"]) * share
        pick[c] = F.coalesce(dbl(c), line, b["v"])
    return out.withColumns(pick).drop("__rn", *wanted)
