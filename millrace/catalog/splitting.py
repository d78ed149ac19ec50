"""Deterministic splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import load, query, r, tidy
from millrace.operators import split

H = "md5(concat_ws(':', cast({} as varchar), '42'))".format("c_custkey")

_PARTS = f"""select *, case when rn <= floor(n * 0.2 + 0.5) then 'test' when rn <= floor(n * {{both}} + 0.5) then 'val' else 'train' end as split
  from (select *, row_number() over (order by {H}) as rn, count(*) over () as n from customer)"""
_TWO = _PARTS.format(both="0.2")
_THREE = _PARTS.format(both="(0.2 + 0.1)")
_BY_CLASS = f"""select *, case when rn <= least(greatest(floor(n * 0.2 + 0.5), 1), n) then 'test' when rn <= floor(n * 0.2 + 0.5) + (floor(n * (0.2 + 0.1) + 0.5) - floor(n * 0.2 + 0.5)) then 'val' else 'train' end as split
  from (select *, row_number() over (partition by c_mktsegment order by {H}) as rn, count(*) over (partition by c_mktsegment) as n from customer)"""


def _customer(spark, sf):
    return load(spark, sf, "customer")


@query("split_random", f"select c_custkey, split from ({_TWO})")
def split_random(spark, sf):
    return split.split_random(_customer(spark, sf), ["c_custkey"]).select("c_custkey", "split")


@query("split_train_val_test", f"select c_custkey, split from ({_THREE})")
def split_train_val_test(spark, sf):
    return split.split_train_val_test(_customer(spark, sf), ["c_custkey"], 0.2, 0.1).select("c_custkey", "split")


@query("split_stratified", f"select c_custkey, c_mktsegment, split from ({_BY_CLASS})")
def split_stratified(spark, sf):
    out = split.split_stratified(_customer(spark, sf), ["c_custkey"], "c_mktsegment", 0.2, 0.1)
    return out.select("c_custkey", "c_mktsegment", "split")


@query(
    "split_lines",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when rn <= floor(n * 0.3 + 0.5) then 'test' else 'train' end as split from (
       select *, row_number() over (order by md5(concat_ws(':', cast(l_orderkey as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar), cast(l_linenumber as varchar), '42'))) as rn, count(*) over () as n from lineitem)""",
)
def split_lines(spark, sf):
    """A four-column key, cut exactly without sorting the table."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return split.split_random(load(spark, sf, "lineitem"), keys, 0.3).select(*keys, "split")


@query("split_guard", "select count(*) as n_rows, true as refused from customer")
def split_guard(spark, sf):
    df = _customer(spark, sf)
    try:
        split.split_train_val_test(df, ["c_custkey"], 0.7, 0.3)
        refused = False
    except ValueError:
        refused = True
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.lit(refused))


@query("split_info", r(f"select split, count(*) as n_rows, count(*) * 100.0 / any_value(n) as pct, 3::bigint as n_features, false as stratified from ({_THREE}) group by 1", "pct"))
def split_info(spark, sf):
    parts = split.split_train_val_test(_customer(spark, sf), ["c_custkey"], 0.2, 0.1)
    return tidy(split.split_info(parts, 3))


@query(
    "split_scaled",
    r(f"""select c_custkey, split, (c_acctbal - mn) / (mx - mn) as c_acctbal from ({_TWO}), (select min(c_acctbal) as mn, max(c_acctbal) as mx from ({_TWO}) where split = 'train') s""", "c_acctbal", 6),
)
def split_scaled(spark, sf):
    parts = split.split_random(_customer(spark, sf), ["c_custkey"])
    return tidy(split.fit_split_scaled(parts, ["c_acctbal"]).transform(parts).select("c_custkey", "split", "c_acctbal"), 6)


@query("train_test_complement", f"select c_custkey from ({_TWO}) where split = 'train'")
def train_test_complement(spark, sf):
    parts = split.split_random(_customer(spark, sf), ["c_custkey"])
    test = parts.where("split = 'test'")
    return split.train_test_complement(_customer(spark, sf), test, ["c_custkey"]).select("c_custkey")
