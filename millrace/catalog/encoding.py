"""Imputation and categorical encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy
from millrace.operators import encode, impute
from millrace.plans.fitted import FittedPlan

RO = dsql("rough_orders")
GE = dsql("gappy_events")

# ---- fills --------------------------------------------------------------------


def _fill(spark, sf, how, cols=("price",)):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", *cols)
    return tidy(impute.fit_impute(df, {c: how for c in cols}).transform(df))


@query("impute_mean", r(f"select o_orderkey, coalesce(price, (select avg(price) from {RO})) as price from {RO}", "price"))
def impute_mean(spark, sf):
    return _fill(spark, sf, "mean")


@query("impute_median", r(f"select o_orderkey, coalesce(price, (select median(price) from {RO})) as price from {RO}", "price"))
def impute_median(spark, sf):
    return _fill(spark, sf, "median")


_MODE = "(select {c} from {t} where {c} is not null group by 1 order by count(*) desc, 1 limit 1)"


@query("impute_mode", f"select o_orderkey, coalesce(prio, {_MODE.format(c='prio', t=RO)}) as prio from {RO}")
def impute_mode(spark, sf):
    return _fill(spark, sf, "mode", ("prio",))


@query("impute_constant", f"select o_orderkey, coalesce(prio, 'Unknown') as prio, coalesce(price, -5) as price, coalesce(sparse, 0) as sparse from {RO}")
def impute_constant(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "prio", "price", "sparse")
    return impute.fit_impute(df, {"prio": "unknown", "price": "const:-5", "sparse": "zero"}).transform(df)


@query("impute_drop_rows", f"select o_orderkey, prio from {RO} where prio is not null")
def impute_drop_rows(spark, sf):
    return _fill(spark, sf, "drop_rows", ("prio",))


_W = "(partition by user_id order by ts, event_id rows between {})"
_BACK = f"last_value(v ignore nulls) over {_W.format('unbounded preceding and current row')}"
_AHEAD = f"first_value(v ignore nulls) over {_W.format('current row and unbounded following')}"


@query("impute_ffill", f"select event_id, coalesce({_BACK}, {_AHEAD}) as v from {GE}")
def impute_ffill(spark, sf):
    df = derived(spark, sf, "gappy_events")
    return impute.ffill(df, ["v"], ["ts", "event_id"], ["user_id"]).select("event_id", "v")


@query("impute_bfill", f"select event_id, coalesce({_AHEAD}, {_BACK}) as v from {GE}")
def impute_bfill(spark, sf):
    df = derived(spark, sf, "gappy_events")
    return impute.bfill(df, ["v"], ["ts", "event_id"], ["user_id"]).select("event_id", "v")


@query(
    "impute_ffill_global",
    f"select event_id, last_value(v ignore nulls) over (order by ts, event_id rows between unbounded preceding and current row) as v from {GE}",
)
def impute_ffill_global(spark, sf):
    """One series over the whole table: still many tasks, linked by carries."""
    df = derived(spark, sf, "gappy_events")
    return impute.ffill(df, ["v"], ["ts", "event_id"], head=False).select("event_id", "v")


@query(
    "impute_interpolate",
    r(
        f"""with n as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from {GE}),
        k as (select *, last_value(v ignore nulls) over a as v0, last_value(case when v is not null then rn end ignore nulls) over a as r0,
              first_value(v ignore nulls) over b as v1, first_value(case when v is not null then rn end ignore nulls) over b as r1 from n
              window a as (partition by user_id order by rn rows between unbounded preceding and current row),
                     b as (partition by user_id order by rn rows between current row and unbounded following))
        select event_id, coalesce(v, v0 + (v1 - v0) * (rn - r0) / nullif(r1 - r0, 0), v0) as v from k""",
        "v",
        6,
    ),
)
def impute_interpolate(spark, sf):
    df = derived(spark, sf, "gappy_events")
    return tidy(impute.interpolate(df, ["v"], ["ts", "event_id"], ["user_id"]).select("event_id", "v"), 6)


def _auto(spark, sf, rule, cols=("o_orderkey", "price", "prio"), **kw):
    df = derived(spark, sf, "rough_orders").select(*cols)
    return tidy(impute.fit_impute_auto(df, rule, skip=["o_orderkey"], **kw).transform(df))


@query("impute_auto_family", r(f"select o_orderkey, coalesce(price, (select median(price) from {RO})) as price, coalesce(prio, 'Unknown') as prio from {RO}", "price"))
def impute_auto_family(spark, sf):
    return _auto(spark, sf, "family")


@query(
    "impute_auto_family_dates",
    r(
        f"""with d as (select event_id, ts, v, case when v is not null then ts end as seen from {GE})
        select event_id, coalesce(v, (select median(v) from d)) as v,
            coalesce(last_value(seen ignore nulls) over (order by ts, event_id rows between unbounded preceding and current row),
                first_value(seen ignore nulls) over (order by ts, event_id rows between current row and unbounded following)) as seen
        from d""",
        "v",
    ),
)
def impute_auto_family_dates(spark, sf):
    df = derived(spark, sf, "gappy_events").select("event_id", "ts", "v", F.when(F.col("v").isNotNull(), F.col("ts")).alias("seen"))
    return tidy(impute.fill_by_family(df, ["ts", "event_id"]).select("event_id", "v", "seen"))


@query(
    "impute_auto_skew",
    r(
        f"""select event_id, coalesce(v, case when abs(sk) > 1 then med else mean end) as v from {GE},
        (select skewness(v) as sk, median(v) as med, avg(v) as mean from {GE}) s""",
        "v",
    ),
)
def impute_auto_skew(spark, sf):
    df = derived(spark, sf, "gappy_events").select("event_id", "v")
    return tidy(impute.fit_impute_auto(df, "skew", skip=["event_id"]).transform(df))


@query("impute_auto_table", r(f"select o_orderkey, coalesce(price, (select median(price) from {RO})) as price, coalesce(prio, {_MODE.format(c='prio', t=RO)}) as prio from {RO}", "price"))
def impute_auto_table(spark, sf):
    return _auto(spark, sf, "table")


@query(
    "impute_per_column",
    r(f"select o_orderkey, coalesce(price, (select avg(price) from {RO})) as price, prio, coalesce(sparse, 7) as sparse from {RO} where prio is not null", "price, sparse"),
)
def impute_per_column(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "price", "prio", "sparse")
    return tidy(impute.fit_impute(df, {"price": "mean", "prio": "drop_rows", "sparse": "constant:7"}).transform(df))


# ---- encoders -----------------------------------------------------------------

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _run(df, steps):
    return FittedPlan(steps if isinstance(steps, list) else [steps]).transform(df)


def _prio(spark, sf):
    return derived(spark, sf, "rough_orders").select("o_orderkey", "prio")


def _hot(c, values, table_col):
    return ", ".join(f"case when {table_col} = '{v}' then 1 else 0 end as \"{c}_{v}\"" for v in values)


@query("encode_onehot", f"select o_orderkey, {_hot('prio', PRIORITIES, 'prio')} from {RO}")
def encode_onehot(spark, sf):
    df = _prio(spark, sf)
    return _run(df, encode.fit_onehot(df, "prio"))


@query("encode_onehot_null_column", f"select o_orderkey, {_hot('prio', PRIORITIES, 'prio')}, case when prio is null then 1 else 0 end as prio_nan from {RO}")
def encode_onehot_null_column(spark, sf):
    df = _prio(spark, sf)
    return _run(df, encode.fit_onehot(df, "prio", null_column=True))


@query("encode_onehot_drop_first", f"select o_orderkey, {_hot('prio', PRIORITIES[1:], 'prio')} from {RO}")
def encode_onehot_drop_first(spark, sf):
    df = _prio(spark, sf)
    return _run(df, encode.fit_onehot(df, "prio", drop_first=True))


@query(
    "encode_label",
    f"select o_orderkey, coalesce(code, -1)::int as prio from {RO} left join (select v, row_number() over (order by v) - 1 as code from (select distinct prio as v from {RO} where prio is not null)) d on prio = v",
)
def encode_label(spark, sf):
    df = _prio(spark, sf)
    return _run(df, encode.fit_label(df, "prio"))


@query("encode_label_wide", "select c_custkey, row_number() over (order by c_name) - 1 as c_name from customer")
def encode_label_wide(spark, sf):
    """A dictionary too large to inline: kept as a table and joined."""
    df = load(spark, sf, "customer").select("c_custkey", "c_name")
    return _run(df, encode.fit_label(df, "c_name")).withColumn("c_name", F.col("c_name").cast("bigint"))


@query("encode_frequency", r("select p_partkey, count(*) over (partition by p_name) / count(*) over () as p_name from part", "p_name", 6))
def encode_frequency(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", "p_name")
    return tidy(_run(df, encode.fit_frequency(df, "p_name")), 6)


@query("encode_binary", "select l_orderkey, l_partkey, l_linenumber, case l_linestatus when 'F' then 0 when 'O' then 1 end as l_linestatus from lineitem")
def encode_binary(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus")
    return _run(df, encode.fit_binary(df, "l_linestatus"))


@query("encode_bool", f"select o_orderkey, case when trim(flag) = 'Yes' then 1 else 0 end as flag from {RO}")
def encode_bool(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "flag")
    return _run(df, encode.fit_encode(df, {"flag": "bool"}))


@query("encode_ordinal", f"select o_orderkey, case prio when '5-LOW' then 0 when '3-MEDIUM' then 1 when '1-URGENT' then 2 else -1 end as prio from {RO}")
def encode_ordinal(spark, sf):
    df = _prio(spark, sf)
    return _run(df, encode.ordinal_step("prio", ["5-LOW", "3-MEDIUM", "1-URGENT"]))


_RP = dsql("rough_parts")


TAGS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget"]


@query(
    "encode_multihot",
    "select p_partkey, "
    + ", ".join(f"coalesce(list_contains(string_split(loose_tags, ', '), '{t}'), false)::int as loose_tags_{t}" for t in TAGS)
    + f" from {_RP}",
)
def encode_multihot_rows(spark, sf):
    df = derived(spark, sf, "rough_parts").select("p_partkey", "loose_tags")
    return _run(df, encode.fit_multihot(df, "loose_tags"))


@query(
    "encode_multihot_counts",
    f"""select trim(t) as tag, count(distinct p_partkey) as n from (select p_partkey, unnest(string_split(loose_tags, ',')) as t from {_RP}) group by 1""",
)
def encode_multihot_counts(spark, sf):
    """Column sums of the indicator columns, one row per tag."""
    df = derived(spark, sf, "rough_parts").select("p_partkey", "loose_tags")
    wide = _run(df, encode.fit_multihot(df, "loose_tags"))
    marks = [c for c in wide.columns if c != "p_partkey"]
    long = wide.unpivot(["p_partkey"], marks, "tag", "mark")
    return long.groupBy(F.expr("substring(tag, length('loose_tags_') + 1)").alias("tag")).agg(F.sum("mark").alias("n"))


@query(
    "encode_auto",
    f"""select o_orderkey, case when trim(flag) = 'Yes' then 1 else 0 end as flag, {_hot('prio', PRIORITIES, 'prio')} from {RO}""",
)
def encode_auto(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "flag", "prio")
    return _run(df, encode.fit_encode_auto(df))


@query(
    "encode_per_column",
    f"select o_orderkey, coalesce(list_position({PRIORITIES}, prio) - 1, -1)::int as prio from {RO}",
)
def encode_per_column(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "flag", "prio")
    return _run(df, encode.fit_encode(df, {"prio": "label", "flag": "skip"}))


@query("encode_residual_sweep", "select o_orderkey, list_position(['F', 'O', 'P'], o_orderstatus)::int - 1 as o_orderstatus, o_totalprice from orders")
def encode_residual_sweep(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return _run(df, encode.fit_residual_sweep(df))


@query("encode_target", r("select p_partkey, avg(p_retailprice) over (partition by p_brand) as p_brand from part", "p_brand"))
def encode_target(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return tidy(_run(df, encode.fit_target(df, "p_brand", "p_retailprice")).select("p_partkey", "p_brand"))


@query("dictionary_lookup", "select o_orderkey, case o_orderstatus when 'F' then 10 when 'O' then 20 else 0 end as o_orderstatus from orders")
def dictionary_lookup(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return encode.dictionary_lookup(df, "o_orderstatus", {"F": 10, "O": 20}, 0)


@query("dictionary_lookup_hot", "select o_orderkey, count(*) over (partition by o_orderpriority) as n from orders")
def dictionary_lookup_hot(spark, sf):
    """The route beyond the broadcast bound, forced: only hot entries are broadcast."""
    from millrace.operators.skew import lookup

    df = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    counts = df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return lookup(df, counts, ["o_orderpriority"], broadcast_rows=0).select("o_orderkey", "n")
