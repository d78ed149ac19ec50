"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy
from millrace.operators import features, impute, split
from millrace.plans.fitted import FittedPlan
from millrace.session import scratch_dir
from millrace.sources import readers, writers

HASH = "md5(concat_ws(':', cast({} as varchar), '42'))"


@query("read_any", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def read_any(spark, sf):
    path = scratch_dir(spark, "any") + ".csv"
    writers.write_csv(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    out = readers.read_any(spark, path)
    return out.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("read_csv_sniff", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def read_csv_sniff(spark, sf):
    path = scratch_dir(spark, "sniff")
    writers.write_csv(load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path, sep=";")
    out = readers.read_csv(spark, path, bad_rows="fail")
    return out.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("read_csv_bad_rows", "select c_custkey, c_mktsegment from customer where c_custkey % 13 <> 0")
def read_csv_bad_rows(spark, sf):
    path = scratch_dir(spark, "bad_rows")
    surplus = F.when(F.col("c_custkey") % 13 == 0, F.lit("a,b"))
    lines = load(spark, sf, "customer").select(F.concat_ws(",", "c_custkey", "c_mktsegment", surplus).alias("value"))
    lines.write.text(path)
    return readers.read_csv(
        spark, path, schema="c_custkey bigint, c_mktsegment string", bad_rows="drop", header=False
    )


@query("read_tsv", "select s_suppkey, s_name, s_acctbal from supplier")
def read_tsv(spark, sf):
    path = scratch_dir(spark, "tsv")
    writers.write_csv(load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path, sep="\t")
    return readers.read_tsv(spark, path).withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query("read_json", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def read_json(spark, sf):
    path = scratch_dir(spark, "json")
    load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").write.json(path)
    return readers.read_json(spark, path)


@query("read_parquet", "select l_orderkey, l_partkey, l_quantity from lineitem where l_discount > 0.05")
def read_parquet(spark, sf):
    df = readers.read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    return df.where("l_discount > 0.05").select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "load_multiple_rows",
    "select c_custkey, c_acctbal, null::bigint as s_suppkey from customer "
    "union all select null, null, s_suppkey from supplier",
)
def load_multiple_rows(spark, sf):
    base = sf.rstrip("/")
    df = readers.load_rows(spark, [f"{base}/customer.parquet", f"{base}/supplier.parquet"])
    return df.select("c_custkey", "c_acctbal", "s_suppkey")


@query(
    "load_multiple_cols",
    "select c_custkey, p_partkey from (select c_custkey, row_number() over (order by c_acctbal, c_custkey) as rn from customer) a "
    "full outer join (select p_partkey, row_number() over (order by p_retailprice, p_partkey) as rn from part) b using (rn)",
)
def load_multiple_cols(spark, sf):
    base = sf.rstrip("/")
    df = readers.load_cols(
        spark, [f"{base}/customer.parquet", f"{base}/part.parquet"], [["c_acctbal", "c_custkey"], ["p_retailprice", "p_partkey"]]
    )
    return df.select("c_custkey", "p_partkey")


@query("peek", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def peek(spark, sf):
    df = load(spark, sf, "orders").withColumn("o", -F.col("o_totalprice"))
    return readers.peek(spark, df, 10, ["o", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("sample_n", f"select o_orderkey, o_totalprice from orders order by {HASH.format('o_orderkey')} limit 100")
def sample_n(spark, sf):
    return split.sample_n(load(spark, sf, "orders"), ["o_orderkey"], 100).select("o_orderkey", "o_totalprice")


@query("sample_n_large", f"select o_orderkey, o_totalprice from orders order by {HASH.format('o_orderkey')} limit 900")
def sample_n_large(spark, sf):
    """The same sample without a sort: a comparison with a fitted hash."""
    df = load(spark, sf, "orders")
    return split.sample_n(df, ["o_orderkey"], 900).select("o_orderkey", "o_totalprice")


@query("file_inventory")
def file_inventory(spark, sf):
    return readers.file_inventory(spark, sf, "*.parquet").select("name", "size", "digest")


@query("write_csv", "select c_custkey, c_mktsegment from customer")
def write_csv(spark, sf):
    path = writers.write_csv(load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), scratch_dir(spark, "csv"))
    return spark.read.csv(path, header=True, schema="c_custkey bigint, c_mktsegment string")


@query(
    "write_split_dataset",
    f"""select c_custkey, c_acctbal, case when rn <= floor(n * 0.2 + 0.5) then 'test'
          when rn <= floor(n * (0.2 + 0.1) + 0.5) then 'val' else 'train' end as split
        from (select *, row_number() over (order by {HASH.format('c_custkey')}) as rn, count(*) over () as n from customer)""",
)
def write_split_dataset(spark, sf):
    parts = split.split_train_val_test(load(spark, sf, "customer"), ["c_custkey"], 0.2, 0.1)
    path = writers.write_split_dataset(parts, scratch_dir(spark, "split"), "c_mktsegment", ["c_acctbal"])
    back, _ = writers.read_split_dataset(spark, path)
    return back.select("c_custkey", "c_acctbal", "split")


@query("write_results_json", "select o_orderpriority, count(*) as n from orders group by 1")
def write_results_json(spark, sf):
    board = load(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return spark.read.json(writers.write_results_json(board, scratch_dir(spark, "results")))


_FITTED_SQL = r(
    f"""select o_orderkey, (coalesce(price, med) - mn) / (mx - mn) as price from {dsql('rough_orders')},
        (select med, least(min(price), med) as mn, greatest(max(price), med) as mx
         from {dsql('rough_orders')}, (select median(price) as med from {dsql('rough_orders')}) m group by med) s""",
    "price",
    6,
)


@query("save_load_fitted", _FITTED_SQL)
def save_load_fitted(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "price")
    fill = impute.fit_impute(df, {"price": "median"})
    plan = FittedPlan([fill, features.fit_scale(fill.transform(df), ["price"], "minmax")])
    path = writers.save_fitted(spark, scratch_dir(spark, "fitted"), plan)
    return tidy(writers.load_fitted(spark, path).transform(df), 6)
