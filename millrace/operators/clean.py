"""Row and column cleaning, validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.functions.numeric import INF, col, dbl, finite
from millrace.operators import schema as S
from millrace.operators.quantiles import exact_quantiles, value_freq
from millrace.plans.fitted import Step, applies

NULL_RATIO = 0.60
TINY_VARIANCE = 1e-10


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def null_ratios(df: DataFrame) -> dict[str, float]:
    row = df.agg(*[F.avg(col(c).isNull().cast("double")).alias(f"r{i}") for i, c in enumerate(df.columns)]).head()
    return {c: row[i] or 0.0 for i, c in enumerate(df.columns)}


def _drop(columns, reason):
    return Step("drop", {"columns": list(columns), "reason": reason})


@applies("drop")
def _apply_drop(df, p):
    return S.drop_columns(df, p["columns"])


def fit_drop_high_null(df: DataFrame, threshold: float = NULL_RATIO, keep=()) -> Step:
    bad = [c for c, r in null_ratios(df).items() if r > threshold and c not in keep]
    return _drop(bad, "nulls")


def fit_drop_empty(df: DataFrame) -> Step:
    return _drop([c for c, r in null_ratios(df).items() if r >= 1.0], "empty")


def drop_empty_rows_cols(df: DataFrame) -> DataFrame:
    return fit_drop_empty(df).transform(df.na.drop(how="all"))


def fit_drop_constant(df: DataFrame, keep=()) -> Step:
    """Constant means min = max (or no value): no distinct count is needed."""
    names = [c for c in df.columns if c not in keep]
    row = df.agg(
        *[
            F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias(f"k{i}")
            for i, c in enumerate(names)
        ]
    ).head()
    return _drop([c for i, c in enumerate(names) if row[i]], "constant")


def fit_drop_low_variance(df: DataFrame, threshold: float = TINY_VARIANCE, keep=()) -> Step:
    names = [c for c in S.numeric_columns(df) if c not in keep]
    if not names:
        return _drop([], "variance")
    row = df.agg(*[F.var_samp(dbl(c)).alias(f"v{i}") for i, c in enumerate(names)]).head()
    return _drop([c for i, c in enumerate(names) if row[i] is not None and row[i] <= threshold], "variance")


def id_report(df: DataFrame, columns: list[str] | None = None, whole_tokens: bool = False) -> DataFrame:
    """One row per numeric column: the facts behind the id rule and the verdict.

    The distinct values are grouped once for all columns; the gaps of the first
    100 come from a per-column top-100 (limited per task before the shuffle).
    """
    names = columns or S.numeric_columns(df)
    freq = value_freq(df, names, "double")
    facts = freq.groupBy("column").agg(
        F.sum("count").alias("n"),
        F.count(F.lit(1)).alias("n_unique"),
        F.max("value").alias("max_value"),
    )
    by_value = Window.partitionBy("column").orderBy("value")
    first = freq.withColumn("rn", F.row_number().over(by_value)).where(F.col("rn") <= 100)
    gaps = (
        first.withColumn("gap", F.col("value") - F.lag("value").over(by_value))
        .groupBy("column")
        .agg(F.stddev_pop("gap").alias("gap_sd"), F.avg("gap").alias("gap_mean"))
    )
    named = F.col("column").isin([c for c in names if S.looks_like_id_name(c, whole_tokens)])
    wide = F.col("n_unique") >= F.col("n") * 0.1
    regular = F.coalesce(F.col("gap_sd") / (F.col("gap_mean") + 1e-10) < 0.1, F.lit(False))
    spread = F.col("max_value") > F.col("n_unique") * 2
    return (
        facts.join(gaps, "column", "left")
        .withColumn("gap_ratio", F.col("gap_sd") / (F.col("gap_mean") + 1e-10))
        .withColumn("is_id", wide & (((F.col("n_unique") > 10) & (regular | spread)) | named))
        .select("column", "n", "n_unique", "max_value", "gap_ratio", "is_id")
    )


def fit_drop_ids(df: DataFrame, keep=(), whole_tokens: bool = False) -> Step:
    found = id_report(df, whole_tokens=whole_tokens).where("is_id").select("column").collect()
    return _drop([r[0] for r in found if r[0] not in keep], "id")


def trim_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(col(c)) for c in S.text_columns(df)})


def lowercase_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lower(F.trim(col(c))) for c in S.text_columns(df)})


def null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: text.null_tokens(col(c), tokens) for c in S.text_columns(df)})


def fit_replace_inf(df: DataFrame, fill: str = "zero", columns: list[str] | None = None) -> Step:
    """Infinities to null, then 0 or the median of the finite values."""
    names = columns or S._kinds(df, (T.DoubleType, T.FloatType))
    if fill == "zero":
        values = {c: 0.0 for c in names}
    else:
        tidy = df.select(*[finite(c).alias(c) for c in names])
        values = {c: q[0] for c, q in exact_quantiles(tidy, names, [0.5]).items()}
    return Step("replace_inf", {"fills": values})


@applies("replace_inf")
def _apply_replace_inf(df, p):
    return df.withColumns(
        {c: F.coalesce(finite(c), F.lit(v).cast("double")) for c, v in p["fills"].items() if c in df.columns}
    )


def fill_residual_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


_INT_TYPES = [("tinyint", 127), ("smallint", 32767), ("int", 2147483647)]


def fit_downcast(df: DataFrame) -> Step:
    """The smallest integer type that holds the range; doubles become floats
    when no value changes by the cast."""
    ints = S._kinds(df, T.IntegralType)
    doubles = S._kinds(df, T.DoubleType)
    aggs = [F.max(F.greatest(col(c), -(col(c) + 1))).alias(f"i{k}") for k, c in enumerate(ints)]
    aggs += [
        F.coalesce(F.bool_and(col(c).cast("float").cast("double") == col(c)), F.lit(True)).alias(f"d{k}")
        for k, c in enumerate(doubles)
    ]
    if not aggs:
        return Step("cast", {"types": {}})
    row = df.agg(*aggs).head()
    types = {}
    for k, c in enumerate(ints):
        for name, bound in _INT_TYPES:
            if row[k] is None or row[k] <= bound:
                types[c] = name
                break
        else:
            types[c] = "bigint"
    for k, c in enumerate(doubles):
        types[c] = "float" if row[len(ints) + k] else "double"
    return Step("cast", {"types": types})


@applies("cast")
def _apply_cast(df, p):
    return df.withColumns({c: col(c).cast(t) for c, t in p["types"].items() if c in df.columns})


def validate(df: DataFrame, required: list[str] = ()) -> DataFrame:
    """(issue, column) rows: empty input, missing, all-null, constant columns."""
    spark = df.sparkSession
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
        *[(F.min(col(c)) == F.max(col(c))).alias(f"m{i}") for i, c in enumerate(df.columns)],
    ).head()
    width = len(df.columns)
    issues = [("missing_required", c) for c in required if c not in df.columns]
    if row["n"] == 0:
        issues.append(("empty", ""))
    for i, c in enumerate(df.columns):
        if row[1 + i] == 0:
            issues.append(("all_null", c))
        if row[1 + i] == 0 or row[1 + width + i]:
            issues.append(("constant", c))
    return spark.createDataFrame(issues, "issue string, `column` string")


def validation_gate(df: DataFrame) -> DataFrame:
    """(level, check, column, count) for what still blocks modelling."""
    numeric = set(S.numeric_columns(df))
    names = names_unique = S.names_dedup(df.columns)
    df = df.toDF(*names_unique)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(names):
        aggs.append(F.count_if(col(c).isNull()).alias(f"null{i}"))
        if c in numeric:
            aggs.append(F.count_if(F.abs(dbl(c)) == F.lit(INF)).alias(f"inf{i}"))
            aggs.append(F.count_if(dbl(c) != 0).alias(f"some{i}"))
    row = df.agg(*aggs).head()
    out = []
    if row["n"] == 0:
        out.append(("error", "no_rows", "", 0))
    if not names:
        out.append(("error", "no_columns", "", 0))
    for i, c in enumerate(names):
        if c.endswith("_dup") and c[: -len("_dup")] in names:
            out.append(("warning", "duplicate_name", c, 1))
        if c not in numeric:
            out.append(("error", "non_numeric", c, row["n"]))
        if row[f"null{i}"]:
            out.append(("error", "nulls", c, row[f"null{i}"]))
        if c in numeric:
            if row[f"inf{i}"]:
                out.append(("error", "infinite", c, row[f"inf{i}"]))
            if row["n"] and not row[f"some{i}"]:
                out.append(("warning", "all_zero", c, row["n"]))
    return df.sparkSession.createDataFrame(
        out, "level string, `check` string, `column` string, `count` bigint"
    )


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=subset)


def any_true(conditions):
    return reduce(lambda a, b: a | b, conditions)
