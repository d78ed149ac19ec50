"""Selection, names, cleaning, validation and types."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy, union_all
from millrace.functions import text
from millrace.functions.numeric import col, dbl, safe_divide
from millrace.operators import clean, features, relate
from millrace.operators import schema as S
from millrace.operators import typing as ty

# ---- projections --------------------------------------------------------------


@query("select_columns", "select o_orderkey, o_totalprice from orders")
def select_columns(spark, sf):
    return S.select_columns(load(spark, sf, "orders"), ["o_orderkey", "not_there", "o_totalprice"])


@query(
    "select_rows",
    "select o_orderkey from (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as pos from orders) where pos in (0, 7, 100, 1499)",
)
def select_rows(spark, sf):
    df = load(spark, sf, "orders")
    return features.row_positions(df, [0, 7, 100, 1499, 10**12, -3], ["o_orderdate", "o_orderkey"]).select("o_orderkey")


@query("drop_columns", "select c_custkey, c_acctbal from customer")
def drop_columns(spark, sf):
    return S.drop_columns(load(spark, sf, "customer"), ["c_name", "c_nationkey", "c_mktsegment", "nope"])


@query("select_by_dtype", "select p_partkey, p_size, p_retailprice from part")
def select_by_dtype(spark, sf):
    return S.select_by_dtype(load(spark, sf, "part"), "numeric")


_MESSY = {" Part Key ": "p_partkey", "Retail Price (USD)": "p_retailprice", "retail__price usd": "p_size", "***": "p_brand"}


def _messy(spark, sf):
    df = load(spark, sf, "part")
    return df.select(*[F.col(c).alias(n) for n, c in _MESSY.items()])


@query("clean_names_trim", 'select p_partkey as "Part Key", p_retailprice as "Retail Price (USD)", p_size as "retail__price usd", p_brand as "***" from part')
def clean_names_trim(spark, sf):
    return S.rename(_messy(spark, sf), "trim")


@query("clean_names_snake", 'select p_partkey as part_key, p_retailprice as "retail_price_(usd)", p_size as retail__price_usd, p_brand as "***" from part')
def clean_names_snake(spark, sf):
    return S.rename(_messy(spark, sf), "snake")


@query("clean_names_ml", 'select p_partkey as part_key, p_retailprice as retail_price_usd, p_size as retail_price_usd_1, p_brand as "column" from part')
def clean_names_ml(spark, sf):
    return S.rename(_messy(spark, sf), "ml")


@query("dedup_column_names", "select p_partkey as k, p_size as k_dup, p_brand as b from part")
def dedup_column_names(spark, sf):
    df = load(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("k"), F.col("p_brand").alias("b"))
    return S.rename(df, "dedup")


# ---- rows and columns ---------------------------------------------------------


@query("drop_duplicates", f"select distinct * from {dsql('doubled_orders')}")
def drop_duplicates(spark, sf):
    return clean.drop_duplicates(derived(spark, sf, "doubled_orders"))


@query(
    "drop_empty_rows_cols",
    f"select quality, toxic from {dsql('graded_docs')} where quality is not null or toxic is not null",
)
def drop_empty_rows_cols(spark, sf):
    df = derived(spark, sf, "graded_docs").select("quality", "toxic", F.lit(None).cast("double").alias("blank"))
    return clean.drop_empty_rows_cols(df)


@query("drop_null_rows", f"select o_orderkey, prio from {dsql('rough_orders')} where price is not null and prio is not null")
def drop_null_rows(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "price", "prio")
    return clean.drop_null_rows(df).select("o_orderkey", "prio")


@query("drop_high_null_columns", f"select o_orderkey, price, prio from {dsql('rough_orders')}")
def drop_high_null_columns(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "price", "sparse", "prio")
    return clean.fit_drop_high_null(df).transform(df)


@query("drop_constant_columns", f"select o_orderkey, price from {dsql('rough_orders')}")
def drop_constant_columns(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "konst", "price")
    return clean.fit_drop_constant(df).transform(df)


@query("drop_low_variance_columns", f"select l_orderkey, disc from {dsql('wide_lines')}")
def drop_low_variance_columns(spark, sf):
    df = derived(spark, sf, "wide_lines").select("l_orderkey", "disc", "konst")
    return clean.fit_drop_low_variance(df).transform(df)


def _id_sql(table: str, cols: list[str], named: set[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"""select '{c}' as "column", n, n_unique, max_value, gap_ratio,
            (n_unique >= n * 0.1 and ((n_unique > 10 and (coalesce(gap_ratio < 0.1, false) or max_value > n_unique * 2))
              or {'true' if c in named else 'false'})) as is_id
            from (select count({c}) as n, count(distinct {c}) as n_unique, max({c})::double as max_value from {table}) f,
            (select stddev_pop(gap) / (avg(gap) + 1e-10) as gap_ratio from
              (select v - lag(v) over (order by v) as gap from
                (select distinct {c}::double as v from {table} order by 1 limit 100))) g"""
        )
    return union_all(parts)


@query("detect_id_columns", r(_id_sql("customer", ["c_custkey", "c_nationkey", "c_acctbal"], {"c_custkey", "c_nationkey"}), "max_value, gap_ratio"))
def detect_id_columns(spark, sf):
    return tidy(clean.id_report(load(spark, sf, "customer")))


@query("drop_id_columns", "select c_mktsegment, c_acctbal from customer")
def drop_id_columns(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return clean.fit_drop_ids(df, keep=["c_acctbal"]).transform(df)


@query("drop_non_numeric", "select c_custkey, c_nationkey, c_acctbal from customer")
def drop_non_numeric(spark, sf):
    return S.select_by_dtype(load(spark, sf, "customer"), "numeric")


@query("trim_text", f"select p_partkey, trim(brand) as brand from {dsql('rough_parts')}")
def trim_text(spark, sf):
    return clean.trim_text(derived(spark, sf, "rough_parts").select("p_partkey", "brand"))


@query("lowercase_text", f"select p_partkey, lower(trim(brand)) as brand from {dsql('rough_parts')}")
def lowercase_text(spark, sf):
    return clean.lowercase_text(derived(spark, sf, "rough_parts").select("p_partkey", "brand"))


@query(
    "null_tokens",
    f"select p_partkey, case when kind in ('nan', 'None', 'null', 'NULL', 'NA', 'N/A', '') then null else kind end as kind from {dsql('rough_parts')}",
)
def null_tokens(spark, sf):
    return clean.null_tokens(derived(spark, sf, "rough_parts").select("p_partkey", "kind"))


_INF = "case when o_orderkey % 50 = 0 then {} else o_totalprice end"


@query(
    "replace_inf",
    "select o_orderkey, coalesce(x, 0) as zeroed, coalesce(x, (select median(case when o_orderkey % 50 <> 0 then o_totalprice end) from orders)) as filled "
    "from (select o_orderkey, case when o_orderkey % 50 <> 0 then o_totalprice end as x from orders)",
)
def replace_inf(spark, sf):
    x = F.expr(_INF.format("double('inf')"))
    df = load(spark, sf, "orders").select("o_orderkey", x.alias("zeroed"), (-x * -1).alias("filled"))
    df = clean.fit_replace_inf(df, "zero", ["zeroed"]).transform(df)
    return clean.fit_replace_inf(df, "median", ["filled"]).transform(df)


@query("fill_residual_zero", f"select o_orderkey, coalesce(price, 0) as price, coalesce(sparse, 0) as sparse from {dsql('rough_orders')}")
def fill_residual_zero(spark, sf):
    return clean.fill_residual_zero(derived(spark, sf, "rough_orders").select("o_orderkey", "price", "sparse"))


@query(
    "downcast_numerics",
    """select c as "column", case when hi <= 127 then 'tinyint' when hi <= 32767 then 'smallint' when hi <= 2147483647 then 'int' else 'bigint' end as type from (
       select 'p_partkey' as c, max(p_partkey) as hi from part union all select 'p_size', max(p_size) from part)
       union all select 'p_retailprice', case when bool_and(p_retailprice::float::double = p_retailprice) then 'float' else 'double' end from part
       union all select 'eighth', 'float'""",
)
def downcast_numerics(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", (F.col("p_size") / 8.0).cast("double").alias("eighth"))
    step = clean.fit_downcast(df)
    out = step.transform(df)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in out.schema.fields], "`column` string, type string")


@query(
    "validate_dataframe",
    f"""select * from (values ('missing_required', 'nope')) v(issue, "column")
        union all select 'all_null', 'blank' from (select 1) where (select count(*) from orders) > 0
        union all select 'constant', 'blank'
        union all select 'constant', 'konst' from (select min(konst) = max(konst) as k from {dsql('rough_orders')}) where k""",
)
def validate_dataframe(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "price", "konst", F.lit(None).cast("int").alias("blank"))
    return clean.validate(df, ["o_orderkey", "nope"])


@query(
    "validation_gate",
    f"""select 'error' as level, 'non_numeric' as "check", 'prio' as "column", count(*) as "count" from {dsql('rough_orders')}
        union all select 'error', 'nulls', 'prio', count(*) from {dsql('rough_orders')} where prio is null
        union all select 'error', 'nulls', 'price', count(*) from {dsql('rough_orders')} where price is null
        union all select 'error', 'infinite', 'edge', count(*) from {dsql('rough_orders')} where o_orderkey % 50 = 0
        union all select 'warning', 'all_zero', 'zero', count(*) from {dsql('rough_orders')}""",
)
def validation_gate(spark, sf):
    df = derived(spark, sf, "rough_orders").select(
        "o_orderkey", "prio", "price",
        F.expr("case when o_orderkey % 50 = 0 then double('inf') else 1.5 end").alias("edge"), F.lit(0).alias("zero"),
    )
    return clean.validation_gate(df)


# ---- types --------------------------------------------------------------------

_TRUE = "('true','yes','1','y','t','on')"
_FALSE = "('false','no','0','n','f','off')"


@query(
    "is_bool_like",
    f"""select 'flag' as "column", bool_and(lower(trim(flag)) in ('true','yes','1','y','t','on','false','no','0','n','f','off')) as is_bool_like from {dsql('rough_orders')}
        union all select 'prio', bool_and(lower(trim(prio)) in ('true','yes')) from {dsql('rough_orders')}""",
)
def is_bool_like(spark, sf):
    return ty.is_bool_like(derived(spark, sf, "rough_orders"), ["flag", "prio"])


@query(
    "bool_to_int",
    f"select o_orderkey, case when lower(trim(flag)) in {_TRUE} then 1 when lower(trim(flag)) in {_FALSE} then 0 end as flag from {dsql('rough_orders')}",
)
def bool_to_int(spark, sf):
    return ty.bool_to_int(derived(spark, sf, "rough_orders").select("o_orderkey", "flag"), ["flag"])


@query(
    "is_numeric_string",
    f"""select 'numtext' as "column", bool_and(try_cast(numtext as double) is not null) as is_numeric_string from {dsql('rough_orders')} where numtext is not null
        union all select 'keytext', bool_and(try_cast(cast(o_orderkey as varchar) as double) is not null) from orders""",
)
def is_numeric_string(spark, sf):
    df = derived(spark, sf, "rough_orders").select("numtext", F.col("o_orderkey").cast("string").alias("keytext"))
    return ty.is_numeric_string(df)


@query("coerce_numeric", f"select o_orderkey, try_cast(numtext as double) as numtext, prio from {dsql('rough_orders')}")
def coerce_numeric(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "numtext", "prio")
    return ty.fit_coerce_numeric(df).transform(df)


_DATE_TEXT = "case when o_orderkey % 9 = 0 then 'later' else strftime(o_orderdate, '%Y-%m-%d') end"


def _date_text(spark, sf):
    d = F.when(F.col("o_orderkey") % 9 == 0, "later").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return load(spark, sf, "orders").select("o_orderkey", d.alias("day"), "o_orderpriority")


@query(
    "is_datetime_like",
    f"""select 'day' as "column", avg(case when regexp_matches(trim({_DATE_TEXT}), '[0-9]{{4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}') then 1.0 else 0.0 end) >= 0.8 as is_datetime_like from orders
        union all select 'o_orderpriority', false""",
)
def is_datetime_like(spark, sf):
    return ty.is_datetime_like(_date_text(spark, sf), ["day", "o_orderpriority"])


@query("is_multilabel", f"""select 'tags' as "column", avg(case when contains(tags, ',') then 1.0 else 0.0 end) >= 0.5 as is_multilabel from {dsql('rough_parts')} union all select 'kind', false""")
def is_multilabel(spark, sf):
    return ty.is_multilabel(derived(spark, sf, "rough_parts"), ["tags", "kind"])


@query(
    "cast_forced",
    f"""select o_orderkey, try_cast(numtext as bigint) as as_int, try_cast(numtext as double) as as_float,
        cast(o_custkey as varchar) as as_str, lower(trim(flag)) in {_TRUE} as as_bool,
        cast(try_cast(case when o_orderkey % 9 = 0 then 'later' else '2024-01-' || lpad(cast(o_orderkey % 28 + 1 as varchar), 2, '0') end as date) as varchar) as as_date
        from {dsql('rough_orders')}""",
)
def cast_forced(spark, sf):
    day = F.when(F.col("o_orderkey") % 9 == 0, "later").otherwise(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("o_orderkey") % 28 + 1).cast("string"), 2, "0"))
    )
    df = derived(spark, sf, "rough_orders").select(
        "o_orderkey", F.col("numtext").alias("as_int"), F.col("numtext").alias("as_float"),
        F.col("o_custkey").alias("as_str"), F.col("flag").alias("as_bool"), day.alias("as_date"),
    )
    out = ty.cast_forced(df, {"as_int": "int", "as_float": "float", "as_str": "str", "as_bool": "bool", "as_date": "date"})
    return out.withColumn("as_date", F.col("as_date").cast("string"))


@query(
    "datetime_parts",
    "select event_id, year(ts)::int as ts_year, month(ts)::int as ts_month, day(ts)::int as ts_day, (isodow(ts) - 1)::int as ts_weekday, hour(ts)::int as ts_hour, minute(ts)::int as ts_minute from events",
)
def datetime_parts(spark, sf):
    return ty.datetime_parts(load(spark, sf, "events").select("event_id", "ts"), ["ts"], with_time=True)


@query(
    "detect_column_type",
    """select * from (values ('c_custkey', 'id'), ('c_name', 'categorical'), ('c_mktsegment', 'categorical')) v("column", semantic)
       union all select 'c_nationkey', case when count(distinct c_nationkey) >= count(*) * 0.1 then 'id' else 'numeric' end from customer
       union all select 'c_acctbal', case when count(distinct c_acctbal) > 10 and count(distinct c_acctbal) >= count(*) * 0.1 and max(c_acctbal) > 2 * count(distinct c_acctbal) then 'id' else 'numeric' end from customer
       union all select 'c_long', case when count(distinct c_long) * 1.0 / count(c_long) >= 0.5 and avg(length(c_long)) > 100 then 'text' else 'categorical' end from (select repeat(c_name, 8) as c_long from customer)""",
)
def detect_column_type(spark, sf):
    df = load(spark, sf, "customer").withColumn("c_long", F.repeat("c_name", 8))
    return ty.detect_column_type(df)


_TYPES = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


@query(
    "column_routing_type",
    """select 'c_mktsegment' as "column", case when count(distinct c_mktsegment) <= 20 then 'categorical' else 'high_cardinality' end as route from customer
       union all select 'c_name', case when count(distinct c_name) <= 20 then 'categorical' else 'high_cardinality' end from customer
       union all select * from (values ('c_custkey', 'numeric'), ('c_nationkey', 'numeric'), ('c_acctbal', 'numeric')) v""",
)
def column_routing_type(spark, sf):
    return ty.column_routing_type(load(spark, sf, "customer"))


def _plan_row(name, null_ratio, n_unique, const, inferred, encoding, action):
    return f"""select '{name}' as "column", round({null_ratio}, 4) + 0.0 as null_ratio, {n_unique} as n_unique, {const} as is_constant, {inferred} as inferred_type, {encoding} as encoding, {action} as action from {dsql('rough_orders')}"""


def _share(c):
    return f"avg(case when {c} is null then 1.0 else 0.0 end)"


_PLAN_SQL = union_all(
    [
        _plan_row("o_orderkey", _share("o_orderkey"), "count(distinct o_orderkey)", "false", "'numeric'", "'none'", "'keep'"),
        _plan_row("price", _share("price"), "count(distinct price)", "false", "'numeric'", "'none'", "'keep'"),
        _plan_row("sparse", _share("sparse"), "count(distinct sparse)", "false", "null", "null", "'drop'"),
        _plan_row("prio", _share("prio"), "count(distinct prio)", "false", "'categorical_low'", "'onehot'", "'keep'"),
        _plan_row("flag", _share("flag"), "count(distinct flag)", "false", "'boolean'", "'bool_to_int'", "'keep'"),
        _plan_row("konst", _share("konst"), "count(distinct konst)", "true", "null", "null", "'drop'"),
    ]
)
_PLAN_COLS = ["o_orderkey", "price", "sparse", "prio", "flag", "konst"]


@query("profile_column_plan", _PLAN_SQL)
def profile_column_plan(spark, sf):
    return tidy(ty.profile_column_plan(derived(spark, sf, "rough_orders").select(*_PLAN_COLS)))


@query(
    "auto_config",
    f"""select "column", null_ratio, n_unique, is_constant, inferred_type,
        case when "column" = 'prio' then 'label' else encoding end as encoding,
        case when "column" = 'sparse' then 'keep' else action end as action from ({_PLAN_SQL})""",
)
def auto_config(spark, sf):
    df = derived(spark, sf, "rough_orders").select(*_PLAN_COLS)
    return tidy(ty.auto_config(df, {"prio": {"encoding": "label"}, "sparse": {"action": "keep"}}))


def _task(table, target, limit=10):
    return f"""select '{target}' as target, count(distinct {target}) as n_unique,
        case when count(distinct {target}) = 2 then 'classification_binary' when count(distinct {target}) <= {limit} then 'classification_multiclass' else 'regression' end as task from {table}"""


@query("detect_task_type", union_all([_task("orders", "o_orderstatus"), _task("orders", "o_totalprice"), _task("labels", "quality"), _task("part", "p_brand")]))
def detect_task_type(spark, sf):
    parts = [("orders", "o_orderstatus"), ("orders", "o_totalprice"), ("labels", "quality"), ("part", "p_brand")]
    out = None
    for table, target in parts:
        one = ty.detect_task_type(load(spark, sf, table), target)
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "infer_problem_type",
    """select 'o_orderstatus' as target, case when k <= 10 then 'classification' else 'regression' end as task_type,
       case when k = 2 then 'binary' when k <= 10 then 'multiclass' else 'continuous' end as severity, true as is_time_series, false as has_text
       from (select count(distinct o_orderstatus) as k from orders)""",
)
def infer_problem_type(spark, sf):
    return ty.infer_problem_type(load(spark, sf, "orders"), "o_orderstatus")


@query("ensure_numeric", f"select o_orderkey, coalesce(try_cast(numtext as double), 0) as numtext, coalesce(price, 0) as price from {dsql('rough_orders')}")
def ensure_numeric(spark, sf):
    return S.ensure_numeric(derived(spark, sf, "rough_orders").select("o_orderkey", "numtext", "price"), fill_zero=True)


# ---- scalar functions ---------------------------------------------------------


@query("safe_divide", r(f"select l_orderkey, l_linenumber, l_partkey, coalesce(price / nullif(tax, 0), -1) as q from {dsql('wide_lines')}", "q"))
def safe_divide_query(spark, sf):
    df = derived(spark, sf, "wide_lines")
    return tidy(df.select("l_orderkey", "l_linenumber", "l_partkey", safe_divide(dbl("price"), dbl("tax"), -1.0).alias("q")))


@query("truncate_text", "select doc_id, case when length(text) <= 50 then text else substr(text, 1, 47) || '...' end as short from documents")
def truncate_text(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.truncate(col("text")).alias("short"))


@query(
    "format_number",
    """select o_orderkey,
       case when abs(x) >= 1e6 then printf('%.2fM', x / 1e6) when abs(x) >= 1e3 then printf('%.2fK', x / 1e3) else printf('%.2f', x) end as short,
       format('{:,}', o_orderkey) as whole, printf('%.1f%%', p * 100) as pct,
       case when b < 1024 then printf('%d B', b) when b < 1048576 then printf('%.2f KB', b / 1024.0::double) else printf('%.2f MB', b / 1048576.0::double) end as bytes,
       case when h > 0 then printf('%dh %dm', h, m) when m > 0 then printf('%dm %ds', m, s) else printf('%ds', s) end as duration
       from (select o_orderkey, (o_orderkey * 17 % 4000000)::double as x, (o_orderkey % 101) / 128.0::double as p, o_orderkey * 96 as b,
             (o_orderkey % 9000) // 3600 as h, (o_orderkey % 9000) % 3600 // 60 as m, (o_orderkey % 9000) % 60 as s from orders)""",
)
def format_number(spark, sf):
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select(
        "o_orderkey", text.format_number((k * 17 % 4000000).cast("double")).alias("short"),
        text.format_integer(k).alias("whole"), text.format_percentage((k % 101) / F.lit(128.0)).alias("pct"),
        text.format_bytes(k * 96).alias("bytes"), text.format_duration(k % 9000).alias("duration"),
    )


@query(
    "filter_pairs",
    """select 'o_orderstatus' as col_a, 'o_orderpriority' as col_b, 'categorical-categorical' as pair_type, count(*) as n
       from orders where o_orderstatus is not null and o_orderpriority is not null""",
)
def filter_pairs(spark, sf):
    df = load(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice")
    pairs = relate.pairwise_tests(df)
    return relate.filter_pairs(pairs, "categorical-categorical").select("col_a", "col_b", "pair_type", "n")
