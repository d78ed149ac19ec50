"""Registration, loading, and the derived inputs that give the clean test
tables nulls, outliers, dirty text and duplicates.

Derived columns are written once as SQL text that Spark and the check engine
both evaluate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded (and -0.0 folded into 0.0) for comparison."""
    return df.select(
        *[
            (F.round(col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col(f.name)
            for f in df.schema.fields
        ]
    )


def r(sql: str, cols: str, digits: int = 4) -> str:
    """The same rounding on the check side."""
    parts = ", ".join(f"round({c.strip()}, {digits}) + 0.0 as {c.strip()}" for c in cols.split(","))
    return f"select * replace ({parts}) from ({sql}) t_"


DERIVED: dict[str, tuple[str, list[str]]] = {
    # orders with nulls, spikes, dirty text, an almost empty and a constant column
    "rough_orders": (
        "orders",
        [
            "o_orderkey",
            "o_custkey",
            "case when o_orderkey % 7 = 0 then null else o_totalprice end as price",
            "case when o_orderkey % 97 = 0 then o_totalprice * 20 else o_totalprice end as spiky",
            "case when o_orderkey % 10 < 7 then null else o_totalprice end as sparse",
            "case when o_orderkey % 5 = 0 then null else o_orderpriority end as prio",
            "case when o_orderstatus = 'O' then ' Yes ' else 'no' end as flag",
            "case when o_orderkey % 11 = 0 then 'n/a' else cast(o_custkey as string) end as numtext",
            "cast(1 as double) as konst",
        ],
    ),
    # numbers only, with nulls, a collinear and a constant column
    "wide_lines": (
        "lineitem",
        [
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "case when l_orderkey % 7 = 0 then null else l_quantity end as qty",
            "l_extendedprice as price",
            "l_extendedprice * 1.01 as price_up",
            "l_discount as disc",
            "case when l_linenumber = 1 then cast(0 as double) else l_tax end as tax",
            "cast(1 as double) as konst",
        ],
    ),
    # a series with gaps
    "gappy_events": (
        "events",
        [
            "event_id", "user_id", "ts", "event_type",
            "case when event_id % 3 = 0 then null else value end as v",
        ],
    ),
    # text cells that stand for null, padded and mixed-case words, tag lists
    "rough_parts": (
        "part",
        [
            "p_partkey",
            "case p_size % 4 when 0 then 'NA' when 1 then 'None' when 2 then '' else p_type end as kind",
            "concat('  ', p_brand, ' ') as brand",
            "replace(p_name, ' ', ',') as tags",
            "case when p_partkey % 6 = 0 then null else replace(p_name, ' ', ', ') end as loose_tags",
            "p_size", "p_retailprice",
        ],
    ),
    # documents with the labels that exist: natural nulls
    "graded_docs": (
        "documents left join labels using (doc_id)",
        ["doc_id", "lang", "source", "n_chars", "quality", "toxic"],
    ),
    # every row twice
    "doubled_orders": (
        "(select * from orders union all select * from orders) o2",
        ["o_orderkey", "o_custkey", "o_orderstatus"],
    ),
}


def derived(spark: SparkSession, sf: str, name: str) -> DataFrame:
    table, exprs = DERIVED[name]
    if name == "graded_docs":
        docs = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left")
        return docs.selectExpr(*exprs)
    if name == "doubled_orders":
        o = load(spark, sf, "orders")
        return o.unionByName(o).selectExpr(*exprs)
    return load(spark, sf, table).selectExpr(*exprs)


def dsql(name: str) -> str:
    """The derived table as a subquery for the check engine."""
    table, exprs = DERIVED[name]
    return f"(select {', '.join(exprs)} from {table}) {name}"


def union_all(parts: list[str]) -> str:
    return " union all ".join(parts)
