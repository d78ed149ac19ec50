"""Column selection, name cleaning and schema-level facts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col
from millrace.functions.text import ID_NAME_WORDS

_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _kinds(df: DataFrame, kind) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c in _kinds(df, T.NumericType) if c not in exclude]


def text_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c in _kinds(df, T.StringType) if c not in exclude]


def time_columns(df: DataFrame) -> list[str]:
    return _kinds(df, _TIME)


def boolean_columns(df: DataFrame) -> list[str]:
    return _kinds(df, T.BooleanType)


def canonical(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column, once at load."""
    floats = _kinds(df, (T.DoubleType, T.FloatType))
    return df.withColumns({c: F.nanvl(col(c), F.lit(None)) for c in floats}) if floats else df


def select_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The requested columns that exist; the whole frame when none does."""
    keep = [c for c in wanted if c in df.columns]
    return df.select(*[col(c) for c in keep]) if keep else df


def drop_columns(df: DataFrame, unwanted: list[str]) -> DataFrame:
    return df.select(*[col(c) for c in df.columns if c not in set(unwanted)])


def select_by_dtype(df: DataFrame, kind: str) -> DataFrame:
    """kind: numeric, text, datetime or non_numeric."""
    groups = {
        "numeric": numeric_columns(df),
        "text": text_columns(df),
        "datetime": time_columns(df),
        "non_numeric": [c for c in df.columns if c not in set(numeric_columns(df))],
    }
    return df.select(*[col(c) for c in groups[kind]])


# ---- names --------------------------------------------------------------------

def names_trimmed(names: list[str]) -> list[str]:
    return [n.strip() for n in names]


def names_snake(names: list[str]) -> list[str]:
    return ["_".join(n.lower().split()) for n in names]


def names_ml(names: list[str]) -> list[str]:
    """Lower-case identifiers; repeats get _1, _2 in order of appearance."""
    base = [re.sub("[^a-z0-9]+", "_", n.lower()).strip("_") or "column" for n in names]
    seen: dict[str, int] = {}
    out = []
    for n in base:
        k = seen.get(n, 0)
        seen[n] = k + 1
        out.append(n if k == 0 else f"{n}_{k}")
    return out


def names_dedup(names: list[str], suffix: str = "_dup") -> list[str]:
    taken: set[str] = set()
    out = []
    for n in names:
        while n in taken:
            n += suffix
        taken.add(n)
        out.append(n)
    return out


def rename(df: DataFrame, how: str) -> DataFrame:
    fn = {"trim": names_trimmed, "snake": names_snake, "ml": names_ml, "dedup": names_dedup}[how]
    return df.toDF(*fn(df.columns))


def looks_like_id_name(name: str, whole_tokens: bool = False) -> bool:
    low = name.lower()
    if whole_tokens:
        return bool(set(re.split("[^a-z0-9]+", low)) & set(ID_NAME_WORDS))
    return any(word in low for word in ID_NAME_WORDS)


def ensure_numeric(df: DataFrame, fill_zero: bool = False, exclude=()) -> DataFrame:
    """Every column as a number; what does not parse becomes null (or 0)."""
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name not in exclude:
            if isinstance(f.dataType, T.BooleanType):
                c = c.cast("int")
            elif isinstance(f.dataType, _TIME):
                c = F.unix_micros(c.cast("timestamp")).cast("double") / 1e6
            elif not isinstance(f.dataType, T.NumericType):
                c = F.trim(c.cast("string")).try_cast("double")
            if fill_zero:
                c = F.coalesce(c, F.lit(0))
        out.append(c.alias(f.name))
    return df.select(*out)


def all_null(cols: list[str]):
    return reduce(lambda a, b: a & b, [col(c).isNull() for c in cols])
