"""Type recognition and conversion: one aggregate decides, a projection converts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.clean import NULL_RATIO, TINY_VARIANCE, id_report
from millrace.operators.quantiles import distinct_counts
from millrace.plans.fitted import Step, applies

COERCE_RATIO = 0.80
LOW_CARD, MED_CARD = 10, 50
CATEGORY_LIMIT = 20


def text_facts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per text column with the shares every recogniser needs."""
    names = S.text_columns(df) if columns is None else columns
    def facts(c):
        x = col(c).cast("string")
        trimmed = F.trim(x)
        n = F.count(x)
        ok = text.parse_number(x).isNotNull()
        return F.struct(
            F.lit(c).alias("column"),
            n.alias("n"),
            F.count(F.lit(1)).alias("n_total"),
            F.coalesce(F.bool_and(text.is_bool_word(x)), F.lit(False)).alias("is_bool_like"),
            F.coalesce(F.bool_and(F.when(x.isNotNull(), ok)), F.lit(False)).alias("is_numeric_string"),
            F.avg(ok.cast("double")).alias("number_ratio"),
            F.coalesce(F.avg(F.when(x.isNotNull(), trimmed.rlike(text.DATE_ANYWHERE).cast("double"))), F.lit(0.0)).alias("date_ratio"),
            F.coalesce(F.bool_or(x.rlike(text.DATE_PREFIX)), F.lit(False)).alias("any_date_prefix"),
            F.coalesce(F.avg(F.when(x.isNotNull(), text.parse_timestamp(x).isNotNull().cast("double"))), F.lit(0.0)).alias("parse_ratio"),
            F.coalesce(F.avg(F.when(x.isNotNull(), trimmed.contains(",").cast("double"))), F.lit(0.0)).alias("comma_ratio"),
            F.coalesce(F.avg(F.length(x).cast("double")), F.lit(0.0)).alias("mean_length"),
        )
    if not names:
        return df.sparkSession.createDataFrame([], _FACTS)
    one = df.agg(F.array(*[facts(c) for c in names]).alias("f"))
    return one.select(F.inline("f"))


_FACTS = (
    "`column` string, n bigint, n_total bigint, is_bool_like boolean, is_numeric_string boolean, "
    "number_ratio double, date_ratio double, any_date_prefix boolean, parse_ratio double, "
    "comma_ratio double, mean_length double"
)


def is_bool_like(df, columns=None):
    return text_facts(df, columns).select("column", (F.col("is_bool_like") & (F.col("n") > 0)).alias("is_bool_like"))


def is_numeric_string(df, columns=None):
    return text_facts(df, columns).select("column", (F.col("is_numeric_string") & (F.col("n") > 0)).alias("is_numeric_string"))


def is_datetime_like(df, columns=None, rule: str = "regex_share"):
    """rule: regex_share (>= 80 %), any_prefix, or parse_share (> 90 %)."""
    verdict = {
        "regex_share": F.col("date_ratio") >= 0.8,
        "any_prefix": F.col("any_date_prefix"),
        "parse_share": F.col("parse_ratio") > 0.9,
    }[rule]
    return text_facts(df, columns).select("column", (verdict & (F.col("n") > 0)).alias("is_datetime_like"))


def is_multilabel(df, columns=None):
    return text_facts(df, columns).select(
        "column", ((F.col("comma_ratio") >= 0.5) & (F.col("n") > 0)).alias("is_multilabel")
    )


def bool_to_int(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text.bool_to_int(col(c)) for c in columns})


def fit_coerce_numeric(df: DataFrame, ratio: float = COERCE_RATIO, strict: bool = False) -> Step:
    """Text columns whose parsed share of all rows reaches ``ratio``."""
    names = S.text_columns(df)
    if not names:
        return Step("coerce_numeric", {"columns": []})
    row = df.agg(
        *[F.avg(text.parse_number(col(c)).isNotNull().cast("double")).alias(f"r{i}") for i, c in enumerate(names)]
    ).head()
    good = [c for i, c in enumerate(names) if row[i] is not None and (row[i] > ratio if strict else row[i] >= ratio)]
    return Step("coerce_numeric", {"columns": good})


@applies("coerce_numeric")
def _apply_coerce(df, p):
    cols = [c for c in p["columns"] if c in df.columns]
    return df.withColumns({c: text.parse_number(col(c)) for c in cols})


_CASTS = {
    "int": lambda c: text.parse_number(c).try_cast("bigint"),
    "float": text.parse_number,
    "str": lambda c: c.cast("string"),
    "bool": lambda c: text.bool_to_int(c) == 1,
    "datetime": text.parse_timestamp,
    "date": lambda c: text.parse_timestamp(c).cast("date"),
}


@applies("cast_forced")
def _apply_cast_forced(df, p):
    return df.withColumns({c: _CASTS[t](col(c)) for c, t in p["types"].items() if c in df.columns})


def cast_forced(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return Step("cast_forced", {"types": types}).transform(df)


@applies("datetime_parts")
def _apply_datetime_parts(df, p):
    parts = {
        "year": F.year, "month": F.month, "day": F.dayofmonth, "weekday": F.weekday,
        "hour": F.hour, "minute": F.minute,
    }
    wanted = list(parts) if p.get("with_time") else list(parts)[:4]
    out = {}
    for c in p["columns"]:
        if c not in df.columns:
            continue
        ts = col(c) if c in S.time_columns(df) else text.parse_timestamp(col(c))
        out.update({f"{c}_{part}": parts[part](ts) for part in wanted})
    done = df.withColumns(out) if out else df
    return S.drop_columns(done, p["columns"])


def datetime_parts(df: DataFrame, columns: list[str], with_time: bool = False) -> DataFrame:
    return Step("datetime_parts", {"columns": columns, "with_time": with_time}).transform(df)


# ---- semantic classes ---------------------------------------------------------

def _schema_kinds(df: DataFrame) -> DataFrame:
    rows = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.BooleanType):
            kind = "boolean"
        elif isinstance(f.dataType, T.NumericType):
            kind = "numeric"
        elif f.name in S.time_columns(df):
            kind = "datetime"
        elif isinstance(f.dataType, T.StringType):
            kind = "text"
        else:
            kind = "other"
        rows.append((f.name, kind, f.dataType.simpleString()))
    return df.sparkSession.createDataFrame(rows, "`column` string, kind string, dtype string")


def _counts(df: DataFrame) -> DataFrame:
    """(column, n_total, n, n_unique): one unpivot, one shuffle."""
    names = df.columns
    sizes = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_total"), F.count(col(c)).alias("n"))
                for c in names
            ]
        ).alias("s")
    ).select(F.inline("s"))
    simple = [c for c in names if not isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))]
    unique = distinct_counts(df, simple)
    return sizes.join(unique, "column", "left").withColumn(
        "n_unique", F.coalesce(F.col("n_unique"), F.lit(0).cast("bigint"))
    )


def detect_column_type(df: DataFrame) -> DataFrame:
    """(column, semantic): empty, id, numeric, boolean, datetime, categorical, text."""
    numeric = S.numeric_columns(df)
    base = _schema_kinds(df).join(_counts(df), "column").join(
        text_facts(df).select("column", "any_date_prefix", "mean_length"), "column", "left"
    )
    if numeric:
        base = base.join(id_report(df, numeric).select("column", "is_id"), "column", "left")
    else:
        base = base.withColumn("is_id", F.lit(False))
    share = F.try_divide(F.col("n_unique").cast("double"), F.col("n").cast("double"))
    semantic = (
        F.when(F.col("n") == 0, "empty")
        .when((F.col("kind") == "numeric") & F.coalesce("is_id", F.lit(False)), "id")
        .when(F.col("kind").isin("numeric", "boolean", "datetime"), F.col("kind"))
        .when((F.col("kind") == "text") & F.col("any_date_prefix"), "datetime")
        .when((F.col("kind") == "text") & (share >= 0.5) & (F.col("mean_length") > 100), "text")
        .when(F.col("kind") == "text", "categorical")
        .otherwise("unknown")
    )
    return base.select("column", semantic.alias("semantic"))


def column_routing_type(df: DataFrame) -> DataFrame:
    """(column, route): numeric, categorical (<= 20 distinct), high_cardinality, datetime."""
    route = (
        F.when(F.col("kind") == "numeric", "numeric")
        .when(F.col("kind") == "datetime", "datetime")
        .when(F.col("kind").isin("text", "boolean") & (F.col("n_unique") <= CATEGORY_LIMIT), "categorical")
        .when(F.col("kind").isin("text", "boolean"), "high_cardinality")
        .otherwise("unknown")
    )
    return _schema_kinds(df).join(_counts(df), "column").select("column", route.alias("route"))


def profile_column_plan(df: DataFrame) -> DataFrame:
    """One decision row per column: null share, distinct, type, encoding, action."""
    numbers = S.numeric_columns(df) + S.text_columns(df)
    base = _schema_kinds(df).join(_counts(df), "column").join(
        text_facts(df).drop("n", "n_total"), "column", "left"
    )
    if numbers:
        as_number = lambda c: dbl(c) if c in S.numeric_columns(df) else text.parse_number(col(c))
        spread = df.agg(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.var_samp(as_number(c)).alias("variance")) for c in numbers]
            ).alias("v")
        ).select(F.inline("v"))
        base = base.join(spread, "column", "left")
    else:
        base = base.withColumn("variance", F.lit(None).cast("double"))
    is_text = F.col("kind") == "text"
    null_ratio = F.try_divide((F.col("n_total") - F.col("n")).cast("double"), F.col("n_total").cast("double"))
    constant = F.col("n_unique") <= 1
    dropped = (null_ratio > NULL_RATIO) | constant
    numeric = (F.col("kind") == "numeric") | (is_text & F.col("is_numeric_string"))
    inferred = (
        F.when(dropped, F.lit(None).cast("string"))
        .when((F.col("kind") == "boolean") | (is_text & F.col("is_bool_like")), "boolean")
        .when(numeric & (F.col("variance") < TINY_VARIANCE), "constant_numeric")
        .when(numeric, "numeric")
        .when((F.col("kind") == "datetime") | (is_text & (F.col("date_ratio") >= 0.8)), "datetime")
        .when(is_text & (F.col("comma_ratio") >= 0.5), "multilabel")
        .when(is_text & (F.col("n_unique") <= LOW_CARD), "categorical_low")
        .when(is_text & (F.col("n_unique") <= MED_CARD), "categorical_med")
        .when(is_text, "categorical_high")
        .otherwise("unknown")
    )
    out = base.select(
        "column",
        F.round(null_ratio, 4).alias("null_ratio"),
        "n_unique",
        constant.alias("is_constant"),
        inferred.alias("inferred_type"),
    )
    t = F.col("inferred_type")
    encoding = (
        F.when(t == "boolean", "bool_to_int")
        .when(t.isin("numeric", "constant_numeric"), "none")
        .when(t == "datetime", "datetime_extract")
        .when(t == "multilabel", "multihot")
        .when(t == "categorical_low", "onehot")
        .when(t.isin("categorical_med", "unknown"), "label")
        .when(t == "categorical_high", "frequency")
    )
    action = F.when(t.isNull() | (t == "constant_numeric"), "drop").otherwise("keep")
    return out.withColumns({"encoding": encoding, "action": action})


def auto_config(df: DataFrame, overrides: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """The decision rows with user overrides merged in."""
    plan = profile_column_plan(df)
    overrides = overrides or {}
    fields = ["inferred_type", "encoding", "action"]
    rows = [(c, *[o.get(f) for f in fields]) for c, o in overrides.items()]
    user = df.sparkSession.createDataFrame(
        rows, "`column` string, u_inferred_type string, u_encoding string, u_action string"
    )
    merged = plan.join(F.broadcast(user), "column", "left")
    return merged.select(
        "column", "null_ratio", "n_unique", "is_constant",
        *[F.coalesce(f"u_{f}", f).alias(f) for f in fields],
    )


def detect_task_type(df: DataFrame, target: str, rule: str = "ten") -> DataFrame:
    """One row: target, n_unique, task.  rule: ten, twenty, or ratio."""
    facts = df.agg(
        F.count_distinct(col(target)).alias("n_unique"), F.count(F.lit(1)).alias("n_rows")
    )
    u = F.col("n_unique")
    regression = isinstance(df.schema[target].dataType, T.NumericType)
    if rule == "ratio":
        per_class = F.try_divide(F.col("n_rows").cast("double"), u.cast("double"))
        task = F.when(u <= 2, "binary").when((u <= 20) & (per_class > 20), "multiclass").otherwise("continuous")
    else:
        limit = {"ten": 10, "twenty": 20}[rule]
        classes = (u <= limit) | F.lit(rule == "twenty" and not regression)
        task = (
            F.when(u == 2, "classification_binary")
            .when(classes, "classification_multiclass")
            .otherwise("regression")
        )
    return facts.select(F.lit(target).alias("target"), "n_unique", task.alias("task"))


def infer_problem_type(df: DataFrame, target: str) -> DataFrame:
    """Task family, class count, and hints for time series and text columns."""
    lowered = target.lower()
    timed = bool(S.time_columns(df)) or "date" in lowered or "time" in lowered
    has_text = detect_column_type(df).agg(
        F.coalesce(F.bool_or(F.col("semantic") == "text"), F.lit(False)).alias("has_text")
    )
    task = detect_task_type(df, target)
    family = F.when(F.col("task").startswith("classification"), "classification").otherwise("regression")
    severity = F.when(F.col("task") == "regression", "continuous").otherwise(
        F.regexp_replace("task", "classification_", "")
    )
    return task.select(
        "target", family.alias("task_type"), severity.alias("severity"),
        F.lit(timed).alias("is_time_series"), has_text.scalar().alias("has_text"),
    )
