"""The numbers behind each chart.  Drawing is left to the caller."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numeric import col, dbl, left_closed_bin
from millrace.operators import schema as S
from millrace.operators.features import base_stats
from millrace.operators.quantiles import exact_quantiles, value_freq
from millrace.operators.relate import corr_matrix, corr_pairs, ols_trendline
from millrace.operators.split import hash_fraction
from millrace.operators.stats import local, per_column

SCATTER_ROWS = 5_000


def _bin_rule(n: int, bins) -> int:
    return min(50, max(10, math.isqrt(n))) if bins == "sqrt" else int(bins)


def histogram(df: DataFrame, cols: list[str], bins=30) -> DataFrame:
    """(column, bin, lower, upper, count) with empty bins; bins="sqrt" takes
    sqrt(n) between 10 and 50.  All columns share one grouped pass."""
    stats = {c: s for c, s in base_stats(df, cols).items() if s["n"]}
    cells, spine = [], []
    for c, s in stats.items():
        k = _bin_rule(s["n"], bins)
        lo, hi = s["min"], s["max"]
        if hi == lo:
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / k
        b = left_closed_bin(dbl(c), lo, hi, k)
        cells.append(F.struct(F.lit(c).alias("column"), b.alias("bin")))
        spine += [(c, i, lo + i * width, lo + (i + 1) * width) for i in range(k)]
    frame = df.sparkSession.createDataFrame(spine, "`column` string, bin int, lower double, upper double")
    if not cells:
        return frame.withColumn("count", F.lit(0).cast("bigint"))
    counts = (
        df.select(F.inline(F.array(*cells))).where("bin is not null")
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    )
    # at most columns x bins rows on either side
    return frame.join(F.broadcast(counts), ["column", "bin"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0).cast("bigint"))
    )


def kde(df: DataFrame, c: str, points: int = 100, bins: int = 512) -> DataFrame:
    """(x, density): Gaussian kernel (Scott bandwidth) over equal-width counts.

    The counts form one array of at most ``bins`` entries, so each grid point
    is a fold over it.
    """
    s = base_stats(df, [c])[c]
    spark = df.sparkSession
    if not s["n"] or not s["sd"]:
        return spark.createDataFrame([], "x double, density double")
    h = s["sd"] * s["n"] ** -0.2
    lo, hi, n = s["min"], s["max"], float(s["n"])
    width = (hi - lo) / bins
    b = left_closed_bin(dbl(c), lo, hi, bins)
    counts = df.select(b.alias("b")).where("b is not null").groupBy("b").agg(F.count(F.lit(1)).cast("double").alias("w"))
    mid = F.lit(lo) + (F.col("b") + 0.5) * F.lit(width)
    packed = counts.agg(F.sort_array(F.collect_list(F.struct(mid.alias("m"), F.col("w")))).alias("bins"))
    start, step = lo - 3 * h, (hi - lo + 6 * h) / (points - 1)
    grid = packed.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.lit(start) + F.col("i") * F.lit(step)
    )
    kernel = F.aggregate(
        "bins", F.lit(0.0),
        lambda acc, e: acc + e["w"] * F.exp(-F.pow((F.col("x") - e["m"]) / F.lit(h), F.lit(2.0)) / 2),
    )
    return grid.select("x", (kernel / F.lit(n * h * math.sqrt(2 * math.pi))).alias("density"))


def box_stats(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extremes inside the fences), outlier count."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    q = {c: v for c, v in q.items() if v[0] is not None}
    table = local(df, q, "`column` string, q1 double, median double, q3 double")
    def facts(c):
        q1, _, q3 = q[c]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = dbl(c)
        inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
        return {
            "whisker_low": F.min(F.when(inside, x)), "whisker_high": F.max(F.when(inside, x)),
            "n_outliers": F.count_if(x.isNotNull() & ~inside),
        }
    return table.join(F.broadcast(per_column(df, list(q), facts)), "column")


def box_points(df: DataFrame, cols: list[str], limit: int | None = None, k: float = 1.5) -> DataFrame:
    """Outlier points per column, the most extreme first; with ``limit`` a top-k report."""
    q = exact_quantiles(df, cols, [0.25, 0.75])
    cells = []
    for c, (q1, q3) in q.items():
        if q1 is None:
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = dbl(c)
        out = F.when((x < F.lit(lo)) | (x > F.lit(hi)), x)
        cells.append(F.struct(F.lit(c).alias("column"), out.alias("value"), F.greatest(F.lit(lo) - x, x - F.lit(hi)).alias("d")))
    w = Window.partitionBy("column").orderBy(F.desc("d"), "value")
    rows = df.select(F.inline(F.array(*cells))).where("value is not null")
    ranked = rows.withColumn("rank", F.row_number().over(w)).select("column", "value", "rank")
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)


def corr_heatmap(df: DataFrame, cols: list[str], max_cols: int = 30, lower: bool = False, method: str = "pearson") -> DataFrame:
    """(row, col, col_a, col_b, value) for the first ``max_cols`` columns."""
    cols = cols[:max_cols]
    order = F.array(*[F.lit(c) for c in cols])
    m = corr_matrix(df, cols, method)
    out = m.select(
        (F.array_position(order, F.col("col_a")) - 1).cast("int").alias("row"),
        (F.array_position(order, F.col("col_b")) - 1).cast("int").alias("col"),
        "col_a", "col_b", "value",
    )
    return out.where("col <= row") if lower else out


def category_bars(df: DataFrame, cols: list[str] | None = None, top: int = 15, max_distinct: int = 25) -> DataFrame:
    """Most frequent values of the columns with at most ``max_distinct``."""
    freq = value_freq(df, cols or S.text_columns(df))
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    few = freq.groupBy("column").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") <= max_distinct)
    ranked = freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(few), "column", "left_semi")  # one row per column


def category_shares(df: DataFrame, cols: list[str] | None = None, low: int = 2, high: int = 10, first: int = 6) -> DataFrame:
    """Shares of the values of the first columns with ``low``..``high`` distinct."""
    cols = cols or S.text_columns(df)
    freq = value_freq(df, cols)
    size = freq.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.sum("count").alias("n"))
    pos = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("column"))
    picked = size.where(F.col("k").between(low, high)).orderBy(pos).limit(first)
    out = freq.join(F.broadcast(picked), "column")
    return out.select("column", "value", "count", (F.col("count") / F.col("n")).alias("share"))


def scatter_sample(df: DataFrame, x: str, y: str, keys: list[str], rows: int = SCATTER_ROWS) -> DataFrame:
    """Points for a scatter chart: the share of rows, by key hash, that makes about ``rows``."""
    part = hash_fraction(df, keys, min(1.0, rows / max(df.count(), 1)))
    return part.select(*[col(k) for k in keys], dbl(x).alias("x"), dbl(y).alias("y")).where("x is not null and y is not null")


def scatter_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and r over all rows."""
    line = ols_trendline(df, x, y)
    r = corr_pairs(df, [x, y]).select("r")
    return line.withColumn("r", r.scalar())


def pair_grid(df: DataFrame, cols: list[str], keys: list[str], hue: str | None = None, first: int = 6, rows: int = SCATTER_ROWS) -> DataFrame:
    """Long (col_x, col_y, x, y, hue) points for every pair of the first columns."""
    cols = cols[:first]
    part = hash_fraction(df, keys, min(1.0, rows / max(df.count(), 1)))
    tone = F.lit(None).cast("string")
    if hue and df.select(col(hue)).distinct().limit(11).count() <= 10:
        tone = col(hue).cast("string")
    cells = [
        F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), dbl(a).alias("x"), dbl(b).alias("y"), tone.alias("hue"))
        for a, b in combinations(cols, 2)
    ]
    return part.select(*[col(k) for k in keys], F.inline(F.array(*cells)))


def relationship_groups(df: DataFrame, groups: dict[str, list[str]], bins: int = 20) -> DataFrame:
    """Tagged rows per column group: histogram diagonal and r of each pair."""
    out = None
    for name, cols in groups.items():
        cols = [c for c in cols if c in df.columns]
        diag = histogram(df, cols, bins).select(
            F.lit(name).alias("group"), F.lit("histogram").alias("kind"), F.col("column").alias("col_a"),
            F.lit(None).cast("string").alias("col_b"), "bin", F.col("count").cast("double").alias("value"),
        )
        r = corr_pairs(df, cols).select(
            F.lit(name).alias("group"), F.lit("r").alias("kind"), "col_a", "col_b",
            F.lit(None).cast("int").alias("bin"), F.col("r").alias("value"),
        )
        part = diag.unionByName(r)
        out = part if out is None else out.unionByName(part)
    return out


def chart_spec(df: DataFrame, spec: dict) -> DataFrame:
    """One tagged long result for the charts a user asked for.

    spec keys: histogram (columns), box (columns), scatter ([x, y] pairs), heatmap (bool).
    """
    parts = []
    null = lambda t: F.lit(None).cast(t)
    if spec.get("histogram"):
        h = histogram(df, spec["histogram"], spec.get("bins", 30))
        parts.append(h.select(F.lit("histogram").alias("chart"), F.col("column").alias("a"), null("string").alias("b"), F.col("bin").cast("string").alias("item"), F.col("count").cast("double").alias("value")))
    if spec.get("box"):
        b = box_stats(df, spec["box"])
        items = F.array(*[F.struct(F.lit(m).alias("item"), F.col(m).cast("double").alias("value")) for m in ("q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")])
        parts.append(b.select(F.lit("box").alias("chart"), F.col("column").alias("a"), null("string").alias("b"), F.inline(items)))
    for x, y in spec.get("scatter", []):
        t = scatter_trend(df, x, y)
        items = F.array(*[F.struct(F.lit(m).alias("item"), F.col(m).alias("value")) for m in ("slope", "intercept", "r")])
        parts.append(t.select(F.lit("scatter").alias("chart"), F.lit(x).alias("a"), F.lit(y).alias("b"), F.inline(items)))
    if spec.get("heatmap"):
        m = corr_matrix(df)
        parts.append(m.select(F.lit("heatmap").alias("chart"), F.col("col_a").alias("a"), F.col("col_b").alias("b"), F.lit("r").alias("item"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
