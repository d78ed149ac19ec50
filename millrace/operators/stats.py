"""Descriptive statistics.  Aggregates of all columns share one pass and are
unpivoted from the single result row with ``inline``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import labels
from millrace.functions import numeric as N
from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.quantiles import distinct_counts, exact_quantiles, modes, value_freq

PROFILE_PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def per_column(df: DataFrame, cols: list[str], facts) -> DataFrame:
    """One row per column of ``facts(name) -> {alias: aggregate}``, in one job."""
    rows = [
        F.struct(F.lit(c).alias("column"), *[e.alias(a) for a, e in facts(c).items()]) for c in cols
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def local(df: DataFrame, rows: dict[str, list], schema: str) -> DataFrame:
    """A small fitted table: one row per column."""
    return df.sparkSession.createDataFrame([(c, *v) for c, v in rows.items()], schema)


def quantile_table(df: DataFrame, cols: list[str], probs: list[float], names: list[str]) -> DataFrame:
    q = exact_quantiles(df, cols, probs)
    return local(df, q, "`column` string, " + ", ".join(f"`{n}` double" for n in names))


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, class counts, nulls, cells, duplicate rows (one row)."""
    numeric = S.numeric_columns(df)
    nulls = reduce(lambda a, b: a + b, [F.count_if(col(c).isNull()) for c in df.columns])
    # rows are told apart by 128 bits; hashes skip nulls, so where they are is hashed too
    cells, gaps = [col(c) for c in df.columns], [col(c).isNull() for c in df.columns]
    digest = [F.xxhash64(*cells, *gaps).alias("__h1"), F.xxhash64(F.lit("row"), *gaps, *reversed(cells)).alias("__h2")]
    groups = df.groupBy(*digest).agg(F.count(F.lit(1)).alias("__copies"))
    facts = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("total_missing"))
    dup = groups.agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_rows"))
    return facts.withColumn("duplicate_rows", dup.scalar()).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(len(numeric)).cast("bigint").alias("n_numeric"),
        F.lit(len(df.columns) - len(numeric)).cast("bigint").alias("n_categorical"),
        "total_missing",
        (F.col("n_rows") * len(df.columns)).alias("total_cells"),
        "duplicate_rows",
    )


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    def facts(c):
        x = dbl(c)
        n, g1, g2 = F.count(x), F.skewness(x), F.kurtosis(x)
        return {
            "n": n, "skew_g1": N.skew_sample(g1, n), "skew_b1": N.skew_b1(g1, n),
            "kurt_g2": N.kurt_sample(g2, n), "kurt_b2": N.kurt_b2(g2, n),
        }
    return per_column(df, cols, facts)


def percentiles(df: DataFrame, cols: list[str], probs: list[float] | None = None) -> DataFrame:
    probs = probs or [0.01, 0.05, 0.25, 0.75, 0.95, 0.99]
    return quantile_table(df, cols, probs, [f"p{p * 100:g}" for p in probs])


def _base(df: DataFrame, cols: list[str]) -> DataFrame:
    def facts(c):
        x = dbl(c)
        n, g1, g2 = F.count(x), F.skewness(x), F.kurtosis(x)
        return {
            "n_total": F.count(F.lit(1)), "n": n, "n_zero": F.count_if(x == 0),
            "mean": F.avg(x), "std": F.sqrt(F.var_samp(x)), "variance": F.var_samp(x),
            "min": F.min(x), "max": F.max(x),
            "skew_g1": N.skew_sample(g1, n), "kurt_g2": N.kurt_sample(g2, n),
            "skew_b1": N.skew_b1(g1, n), "kurt_b2": N.kurt_b2(g2, n),
        }
    return per_column(df, cols, facts)


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, median, std, min, max, quartiles, iqr, G1, G2, missing, unique."""
    cols = cols or S.numeric_columns(df)
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], ["q25", "median", "q75"])
    unique = modes(df, cols, "double").select("column", "n_unique")
    return (
        _base(df, cols).join(F.broadcast(q), "column").join(F.broadcast(unique), "column", "left")
        .select(
            "column", F.col("n").alias("count"), "mean", "median", "std", "min", "max", "q25", "q75",
            (F.col("q75") - F.col("q25")).alias("iqr"),
            F.col("skew_g1").alias("skewness"), F.col("kurt_g2").alias("kurtosis"),
            (F.col("n_total") - F.col("n")).alias("missing"),
            F.coalesce("n_unique", F.lit(0).cast("bigint")).alias("unique"),
        )
    )


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or S.text_columns(df)
    sizes = per_column(df, cols, lambda c: {"n_total": F.count(F.lit(1)), "n": F.count(col(c))})
    return sizes.join(modes(df, cols), "column", "left").select(
        "column", sizes["n"].alias("count"),
        F.coalesce("n_unique", F.lit(0).cast("bigint")).alias("unique"),
        F.col("mode").alias("top"), F.col("mode_count").alias("top_freq"),
        (F.col("n_total") - sizes["n"]).alias("missing"),
    )


def top_values(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """k most frequent values per column, ties by value.

    ``row_number <= k`` lets Spark keep only k rows per column and task before
    the shuffle, so a column with billions of values stays cheap.
    """
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return value_freq(df, cols).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def value_counts(df: DataFrame, c: str) -> DataFrame:
    counts = df.groupBy(col(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return counts.select("value", "count", (F.col("count") / total.scalar()).alias("share"))


def missing_report(df: DataFrame) -> DataFrame:
    out = per_column(
        df, df.columns,
        lambda c: {"missing": F.count_if(col(c).isNull()), "n": F.count(F.lit(1))},
    )
    pct = F.round(F.coalesce(F.try_divide(F.col("missing").cast("double"), F.col("n").cast("double")), F.lit(0.0)) * 100, 2)
    return (
        out.select("column", "missing", pct.alias("pct"))
        .withColumn("severity", labels.missing_severity(F.col("pct")))
        .orderBy(F.desc("pct"), "column")
    )


def full_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """27-field profile of numeric columns."""
    cols = cols or S.numeric_columns(df)
    names = ["p1", "p5", "p25", "median", "p75", "p95", "p99"]
    q = exact_quantiles(df, cols, PROFILE_PROBS)
    def out_count(c):
        q1, q3 = q[c][2], q[c][4]
        if q1 is None:
            return {"n_iqr_outliers": F.lit(0).cast("bigint")}
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        return {"n_iqr_outliers": F.count_if((dbl(c) < F.lit(lo)) | (dbl(c) > F.lit(hi)))}
    qt = local(df, q, "`column` string, " + ", ".join(f"{n} double" for n in names))
    freq = modes(df, cols, "double").select("column", "n_unique", "mode")
    base = (
        _base(df, cols).join(F.broadcast(qt), "column")
        .join(F.broadcast(per_column(df, cols, out_count)), "column")
        .join(F.broadcast(freq), "column", "left")
        .withColumn("n_unique", F.coalesce("n_unique", F.lit(0).cast("bigint")))
    )
    return base.select(
        "column", "n_total", (F.col("n_total") - F.col("n")).alias("n_null"),
        F.try_divide((F.col("n_total") - F.col("n")).cast("double"), F.col("n_total").cast("double")).alias("null_pct"),
        "n_zero", "n_unique", "mean", "median", "mode", "std", "variance", "min", "max",
        (F.col("max") - F.col("min")).alias("range"),
        "p1", "p5", "p25", "p75", "p95", "p99",
        (F.col("p75") - F.col("p25")).alias("iqr"),
        F.col("skew_b1").alias("skewness"), F.col("kurt_b2").alias("kurtosis"),
        F.try_divide(F.col("std"), F.col("mean")).alias("cv"),
        "n_iqr_outliers",
        labels.distribution(F.col("skew_b1"), F.col("kurt_b2"), F.col("n_unique")).alias("distribution"),
    )


def profile_mixed(df: DataFrame) -> DataFrame:
    """Numeric and text columns in one frame, with the tail-aware shape label."""
    numbers, words = S.numeric_columns(df), S.text_columns(df)
    parts = []
    if numbers:
        d = describe_numeric(df, numbers)
        base = _base(df, numbers).select("column", "skew_b1", "kurt_b2", "n_total")
        parts.append(
            d.join(F.broadcast(base), "column").select(
                "column", F.lit("numeric").alias("dtype"), F.col("n_total").alias("count"),
                F.col("missing").alias("null_count"), "unique", "mean", "median", "std", "min", "max",
                "q25", "q75", "iqr", F.col("skew_b1").alias("skewness"), F.col("kurt_b2").alias("kurtosis"),
                F.lit(None).cast("string").alias("mode"),
                labels.distribution_by_tails(F.col("skew_b1"), F.col("kurt_b2"), F.col("std")).alias("distribution"),
            )
        )
    if words:
        c = describe_categorical(df, words)
        parts.append(
            c.select(
                "column", F.lit("categorical").alias("dtype"), (F.col("count") + F.col("missing")).alias("count"),
                F.col("missing").alias("null_count"), "unique", F.col("top").alias("mode"),
                F.lit("categorical").alias("distribution"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def distribution_labels(df: DataFrame, cols: list[str], rule: str = "shape") -> DataFrame:
    """(column, distribution); rule: shape, or tails."""
    base = _base(df, cols)
    if rule == "tails":
        label = labels.distribution_by_tails(F.col("skew_b1"), F.col("kurt_b2"), F.col("std"))
        return base.select("column", label.alias("distribution"))
    unique = modes(df, cols, "double").select("column", "n_unique")
    label = labels.distribution(
        F.col("skew_b1"), F.col("kurt_b2"), F.coalesce("n_unique", F.lit(0).cast("bigint"))
    )
    return base.join(F.broadcast(unique), "column", "left").select("column", label.alias("distribution"))


def distribution_breakdown(df: DataFrame, cols: list[str], rule: str = "shape") -> DataFrame:
    return distribution_labels(df, cols, rule).groupBy("distribution").agg(F.count(F.lit(1)).alias("n_columns"))


def column_info(df: DataFrame, order_by: list[str]) -> DataFrame:
    """dtype, nulls, distinct, and the first non-null value of the given order."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    order = F.struct(*[col(c) for c in order_by])
    facts = per_column(
        df, df.columns,
        lambda c: {
            "dtype": F.lit(kinds[c]), "n_total": F.count(F.lit(1)), "null_count": F.count_if(col(c).isNull()),
            "sample": F.min_by(col(c).cast("string"), F.when(col(c).isNotNull(), order)),
        },
    )
    unique = distinct_counts(df, df.columns)
    pct = lambda x: F.round(F.try_divide(F.col(x).cast("double"), F.col("n_total").cast("double")) * 100, 2)
    return (
        facts.join(F.broadcast(unique), "column", "left")
        .withColumn("n_unique", F.coalesce("n_unique", F.lit(0).cast("bigint")))
        .select("column", "dtype", "null_count", pct("null_count").alias("null_pct"), "n_unique",
                pct("n_unique").alias("unique_pct"), "sample")
    )


def health_scores(df: DataFrame) -> DataFrame:
    miss = missing_report(df).agg(F.count_if(F.col("missing") == 0).alias("complete_columns"))
    o = overview(df).withColumn("complete_columns", miss.scalar())
    share = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0)) * 100, 2)
    return o.select(
        (100 - share("total_missing", "total_cells")).alias("completeness"),
        (100 - share("duplicate_rows", "n_rows")).alias("uniqueness"),
        "complete_columns", "n_columns",
    )


def entropy(df: DataFrame, c: str, base: float = 2.0) -> DataFrame:
    """Shannon entropy of the non-null values: log n - sum(k log k) / n."""
    counts = df.where(col(c).isNotNull()).groupBy(col(c)).agg(F.count(F.lit(1)).cast("double").alias("k"))
    nats = F.log(F.sum("k")) - F.sum(F.col("k") * F.log("k")) / F.sum("k")
    return counts.agg(F.coalesce(nats / F.log(F.lit(base)), F.lit(0.0)).alias("entropy"))


def class_balance(df: DataFrame, target: str, limit: int = 20) -> DataFrame:
    """Counts and shares of the classes; empty when there are more than ``limit``."""
    counts = value_counts(df.where(col(target).isNotNull()), target)
    few = df.agg((F.count_distinct(col(target)) <= limit).alias("ok"))
    return counts.where(few.scalar())


def most_skewed(df: DataFrame, cols: list[str], k: int = 5, limit: float = 0.5) -> DataFrame:
    m = moments(df, cols).select("column", F.col("skew_b1").alias("skewness"))
    return m.where(F.abs("skewness") > limit).orderBy(F.desc(F.abs("skewness")), "column").limit(k)

