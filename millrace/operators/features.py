"""Derived columns, scaling and log transforms."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import numeric as N
from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.skew import MAX_CHUNKS, lookup, with_row_number
from millrace.plans.fitted import Step, applies
from millrace.session import parallelism

RANK_VALUES = 50_000


def base_stats(df: DataFrame, cols: list[str]) -> dict[str, dict]:
    """count, mean, both deviations, min, max and G1 of every column, one job."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = dbl(c)
        aggs.append(
            F.struct(
                F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var"),
                F.min(x).alias("min"), F.max(x).alias("max"), F.skewness(x).alias("g1"),
            ).alias(f"s{i}")
        )
    row = df.agg(*aggs).head()
    out = {}
    for i, c in enumerate(cols):
        s = row[i].asDict()
        n, var, g1 = s["n"], s.pop("var"), s.pop("g1")
        s["sd_pop"] = None if var is None else var**0.5
        s["sd"] = (var * n / (n - 1)) ** 0.5 if n > 1 else None
        s["skew"] = g1 * (n * (n - 1)) ** 0.5 / (n - 2) if g1 is not None and n > 2 else None
        out[c] = s
    return out


# ---- scaling ------------------------------------------------------------------

@applies("affine")
def _apply_affine(df, p):
    """(x - shift) / scale per column."""
    return df.withColumns(
        {c: (dbl(c) - F.lit(a)) / F.lit(b) for c, (a, b) in p["columns"].items() if c in df.columns}
    )


def fit_scale(df: DataFrame, cols: list[str], how: str = "standard", ddof: int = 0, constant: str = "zero") -> Step:
    """how: minmax, standard, robust, auto.

    ``constant``: a column without spread becomes 0 (zero) or is left alone (keep).
    """
    stats = base_stats(df, cols) if how != "robust" else {}
    if how == "auto":
        wide = any(
            s["mean"] and s["sd"] is not None and s["sd"] / abs(s["mean"]) > 0.5 for s in stats.values()
        )
        how = "robust" if wide else "standard"
    params = {}
    if how == "robust":
        for c, (q1, q2, q3) in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).items():
            if q2 is not None:
                params[c] = (q2, (q3 - q1) or 1.0)
    else:
        for c, s in stats.items():
            if not s["n"]:
                continue
            shift = s["min"] if how == "minmax" else s["mean"]
            spread = s["max"] - s["min"] if how == "minmax" else s["sd" if ddof else "sd_pop"]
            if spread:
                params[c] = (shift, spread)
            elif constant == "zero":
                params[c] = (shift, 1.0)
    return Step("affine", {"columns": params, "how": how})


@applies("log1p")
def _apply_log1p(df, p):
    return df.withColumns(
        {p["names"].get(c, c): F.log1p(F.greatest(dbl(c), F.lit(0.0))) for c in p["columns"] if c in df.columns}
    )


def fit_log_skewed(df: DataFrame, cols: list[str] | None = None, in_place: bool = True) -> Step:
    """log1p of skewed columns: in place when all > 0 and |G1| > 1, or as a new
    ``_log1p`` column when min >= 0 and |G1| > 2."""
    names = S.numeric_columns(df) if cols is None else cols
    chosen = []
    for c, s in base_stats(df, names).items():
        skew = abs(s["skew"] or 0.0)
        if s["n"] and ((s["min"] > 0 and skew > 1.0) if in_place else (s["min"] >= 0 and skew > 2.0)):
            chosen.append(c)
    return Step("log1p", {"columns": chosen, "names": {} if in_place else {c: f"{c}_log1p" for c in chosen}})


# ---- derived columns ----------------------------------------------------------

def _ratio(a, b, rule):
    if rule == "null":
        return F.try_divide(dbl(a), dbl(b))
    denominator = F.coalesce(F.nullif(dbl(b), F.lit(0.0)), F.lit(1.0))
    return F.coalesce(dbl(a) / denominator, F.lit(0.0))


def _clipped(c):
    x = dbl(c)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def _rule_columns(rule: dict, stats: dict) -> dict:
    """New columns of one rule that is a pure projection."""
    kind, name = rule["type"], rule.get("name", "")
    a, b, c = rule.get("col_a"), rule.get("col_b"), rule.get("col")
    cols = [dbl(x) for x in rule.get("cols", [])]
    if kind == "ratio":
        return {name or f"{a}_div_{b}": _ratio(a, b, rule.get("zero", "null"))}
    if kind == "diff":
        return {name or f"{a}_minus_{b}": dbl(a) - dbl(b)}
    if kind in ("product", "interaction"):
        return {name or f"{a}_x_{b}": dbl(a) * dbl(b)}
    if kind.startswith("agg_"):
        fn = {
            "agg_mean": N.row_mean, "agg_sum": N.row_sum, "agg_max": N.row_max,
            "agg_min": N.row_min, "agg_std": N.row_std,
        }[kind]
        return {name or kind: fn(cols)}
    if kind == "log1p":
        return {name or f"{c}_log1p": F.log1p(_clipped(c))}
    if kind == "square":
        return {name or f"{c}_sq": dbl(c) * dbl(c)}
    if kind == "sqrt":
        return {name or f"{c}_sqrt": F.sqrt(_clipped(c))}
    if kind == "polynomial":
        degree = rule.get("degree")
        if degree:
            return {f"{c}_pow{d}": F.pow(dbl(c), F.lit(float(d))) for d in range(2, degree + 1)}
        return {f"{c}_sq": F.pow(dbl(c), F.lit(2.0)), f"{c}_cub": F.pow(dbl(c), F.lit(3.0))}
    if kind == "zscore":
        s = stats[c]
        return {name or f"{c}_zscore": (dbl(c) - F.lit(s["mean"])) / F.lit((s["sd"] or 0.0) + 1e-9)}
    if kind == "bin":
        s = stats[c]
        binned = N.equal_width_bin(dbl(c), s["min"], s["max"], int(rule.get("n_bins", rule.get("bins", 5))))
        labels = rule.get("labels")
        if labels:
            return {name or f"{c}_bin": F.try_element_at(F.array(*[F.lit(x) for x in labels]), binned + 1)}
        if rule.get("null_code") is not None:
            binned = F.coalesce(binned, F.lit(int(rule["null_code"])))
        return {name or f"{c}_bin": binned}
    raise ValueError(f"unknown feature rule {kind!r}")


def _inputs(rule):
    return [rule[k] for k in ("col", "col_a", "col_b") if rule.get(k)] + list(rule.get("cols", []))


@applies("rules")
def _apply_rules(df, p):
    """Every projection rule in one ``withColumns``; ranks need a pass of their own."""
    out = {}
    for rule in p["rules"]:
        if rule["type"] != "rank" and all(c in df.columns for c in _inputs(rule)):
            out.update(_rule_columns(rule, p["stats"]))
    done = df.withColumns(out) if out else df
    for rule in p["rules"]:
        if rule["type"] == "rank" and rule["col"] in df.columns:
            done = rank_pct(done, rule["col"], rule.get("name") or f"{rule['col']}_rank")
    return done


def fit_rules(df: DataFrame, rules: list[dict]) -> Step:
    """Rules whose columns are missing are skipped; row aggregates use what exists."""
    usable = []
    for r in rules:
        if r.get("cols"):
            r = {**r, "cols": [c for c in r["cols"] if c in df.columns]}
            if not r["cols"]:
                continue
        if all(c in df.columns for c in _inputs(r)):
            usable.append(r)
    need = sorted({r["col"] for r in usable if r["type"] in ("zscore", "bin")})
    return Step("rules", {"rules": usable, "stats": base_stats(df, need)})


def add_features(df: DataFrame, rules: list[dict]) -> DataFrame:
    return fit_rules(df, rules).transform(df)


def interactions(df: DataFrame, cols: list[str], first: int = 5, second: int = 6) -> DataFrame:
    """Products among the leading columns: each of the first five with the
    later ones up to the sixth."""
    lead = cols[:second]
    pairs = [(a, b) for a, b in combinations(lead, 2) if lead.index(a) < first]
    return df.withColumns({f"{a}_x_{b}": dbl(a) * dbl(b) for a, b in pairs})


def row_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    xs = [dbl(c) for c in cols]
    return df.withColumns(
        {"_row_mean": N.row_mean(xs), "_row_std": N.row_std(xs), "_row_min": N.row_min(xs), "_row_max": N.row_max(xs)}
    )


# ---- ranks --------------------------------------------------------------------

def rank_table(df: DataFrame, c: str) -> DataFrame:
    """(value, cnt, avg_rank) per distinct value of a column with few of them."""
    freq = df.select(dbl(c).alias("value")).where("value is not null").groupBy("value").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    w = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("cnt").over(w), F.lit(0))
    return freq.select("value", "cnt", (below + (F.col("cnt") + 1) / 2).alias("avg_rank"))


def with_avg_rank(df: DataFrame, c: str, name: str, few: int = RANK_VALUES) -> DataFrame:
    """Average-tie rank of the non-null values of a column.

    Few distinct values: a counted dictionary, broadcast.  Many: rows are cut
    into value ranges at quantiles (a value that fills a range gets its own),
    ranked inside a range and shifted by the counts of the ranges before.  The
    rows of a single-value range share one known rank and are not shuffled.
    """
    parts = min(parallelism(df.sparkSession), MAX_CHUNKS)
    x = dbl(c)
    probs = [i / parts for i in range(1, parts)] or [0.5]
    distinct, q = df.agg(
        F.approx_count_distinct(x, 0.02), F.percentile_approx(x, probs, 20 * parts)
    ).head()
    if distinct <= few:
        table = rank_table(df, c).select(F.col("value").alias("__value"), F.col("avg_rank").alias(name))
        return lookup(df.withColumn("__value", x), table, ["__value"], rows=distinct).drop("__value")

    cuts = set(q)
    heavy = {v for v in q if q.count(v) > 1}
    cuts |= {float(np.nextafter(v, np.inf)) for v in heavy}
    splits = [float("-inf"), *sorted(cuts), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="__value", outputCol="__range", handleInvalid="keep")
    ranged = cut.transform(df.withColumn("__value", x)).withColumn(
        "__range", F.coalesce(F.col("__range").cast("int"), F.lit(-1))
    )
    # one row per range, at most 2 * MAX_CHUNKS + 1
    sizes = dict(ranged.where("__value is not null").groupBy("__range").count().collect())
    before, seen = {}, 0
    for i in sorted(sizes):
        before[i], seen = seen, seen + sizes[i]
    shift = F.element_at(F.array(*[F.lit(before.get(i, 0)) for i in range(len(splits))]), F.col("__range") + 1)
    alone = sorted(splits.index(v) for v in heavy if splits.index(v) in sizes)
    alike = F.col("__value").isNull() | F.col("__range").isin(alone)
    size = F.element_at(F.array(*[F.lit(sizes.get(i, 0)) for i in range(len(splits))]), F.col("__range") + 1)
    same = ranged.where(alike).withColumn(name, F.when(F.col("__value").isNotNull(), shift + (size + 1) / 2))
    w = Window.partitionBy("__range").orderBy("__value")
    ties = Window.partitionBy("__range", "__value")
    inside = F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2
    mixed = ranged.where(~alike).withColumn(name, shift + inside)
    return same.unionByName(mixed).drop("__value", "__range")


def rank_pct(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    """Average-tie rank over the non-null count."""
    name = name or f"{c}_rank"
    n = df.agg(F.count(dbl(c))).head()[0]
    return with_avg_rank(df, c, name).withColumn(name, F.col(name) / F.lit(float(max(n, 1))))


def row_positions(df: DataFrame, positions: list[int], order_by: list[str]) -> DataFrame:
    """Rows at 0-based positions of the given order; out-of-range ones are ignored."""
    wanted = [int(p) + 1 for p in positions if p >= 0]
    return with_row_number(df, order_by, name="__pos").where(F.col("__pos").isin(wanted)).drop("__pos")
