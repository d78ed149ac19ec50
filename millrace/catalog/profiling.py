"""Descriptive statistics, profiles and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy, union_all
from millrace.functions import labels
from millrace.operators import chartdata, outliers, stats
from millrace.operators import typing as ty
from millrace.plans import run as runs
from millrace.plans.config import PrepConfig

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def per(cols, template, table):
    """One select per column, glued together."""
    return union_all([template.format(c=c, t=table) for c in cols])


def _b1(c):
    g1 = f"(skewness({c}) * (count({c}) - 2) / sqrt(count({c})::double * (count({c}) - 1)))"
    return f"({g1} * pow((count({c}) - 1) / count({c})::double, 1.5))"


def _b2(c):
    return f"((kurtosis_pop({c}) + 3) * pow((count({c}) - 1) / count({c})::double, 2) - 3)"


_WIDE = dsql("wide_lines")
_WIDE_NUM = ["qty", "price", "disc", "tax"]


@query(
    "overview",
    f"""select count(*) as n_rows, 3::bigint as n_columns, 2::bigint as n_numeric, 1::bigint as n_categorical, 0::bigint as total_missing,
        count(*) * 3 as total_cells, count(*) - (select count(*) from (select distinct * from {dsql('doubled_orders')})) as duplicate_rows
        from {dsql('doubled_orders')}""",
)
def overview(spark, sf):
    return stats.overview(derived(spark, sf, "doubled_orders"))


@query(
    "describe_numeric",
    r(
        per(
            _WIDE_NUM,
            """select '{c}' as "column", count({c}) as "count", avg({c}) as mean, median({c}) as median, stddev_samp({c}) as std, min({c}) as "min", max({c}) as "max",
            quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.75) as q75, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as iqr,
            skewness({c}) as skewness, kurtosis({c}) as kurtosis, count(*) - count({c}) as missing, count(distinct {c}) as "unique" from {t}""",
            _WIDE,
        ),
        'mean, median, std, "min", "max", q25, q75, iqr, skewness, kurtosis',
    ),
)
def describe_numeric(spark, sf):
    return tidy(stats.describe_numeric(derived(spark, sf, "wide_lines"), _WIDE_NUM))


def _top_sql(table, cols, k):
    return union_all(
        [
            f"""select * from (select '{c}' as "column", cast({c} as varchar) as value, count(*) as "count",
            row_number() over (order by count(*) desc, cast({c} as varchar)) as rank from {table} where {c} is not null group by 2) where rank <= {k}"""
            for c in cols
        ]
    )


@query(
    "describe_categorical",
    per(
        ["prio", "flag"],
        """select '{c}' as "column", count({c}) as "count", count(distinct {c}) as "unique",
        (select {c} from {t} where {c} is not null group by 1 order by count(*) desc, 1 limit 1) as top,
        (select count(*) from {t} where {c} is not null group by {c} order by 1 desc limit 1) as top_freq, count(*) - count({c}) as missing from {t}""",
        dsql("rough_orders"),
    ),
)
def describe_categorical(spark, sf):
    return stats.describe_categorical(derived(spark, sf, "rough_orders"), ["prio", "flag"])


@query("top_values", f"""select "column", value, "count", rank::int as rank from ({_top_sql('part', ['p_brand', 'p_type', 'p_size'], 5)})""")
def top_values(spark, sf):
    return stats.top_values(load(spark, sf, "part"), ["p_brand", "p_type", "p_size"], 5)


@query("value_counts", r("select prio as value, count(*) as \"count\", count(*) / sum(count(*)) over () as share from " + dsql("rough_orders") + " group by 1", "share"))
def value_counts(spark, sf):
    return tidy(stats.value_counts(derived(spark, sf, "rough_orders"), "prio"))


def _missing_sql(table, cols):
    return f"""select "column", missing, round(missing * 100.0 / n, 2) + 0.0 as pct,
      case when missing * 100.0 / n > 20 then 'high' when missing * 100.0 / n > 5 then 'medium' else 'low' end as severity from ({per(cols, "select '{c}' as " + '"column"' + ", count(*) - count({c}) as missing, count(*)::double as n from {t}", table)})"""


_ROUGH = ["o_orderkey", "o_custkey", "price", "spiky", "sparse", "prio", "flag", "numtext", "konst"]


@query("missing_report", _missing_sql(dsql("rough_orders"), _ROUGH))
def missing_report(spark, sf):
    return stats.missing_report(derived(spark, sf, "rough_orders"))


@query("missing_bars", f'select "column", pct from ({_missing_sql(dsql("graded_docs"), ["doc_id", "lang", "source", "n_chars", "quality", "toxic"])})')
def missing_bars(spark, sf):
    return stats.missing_report(derived(spark, sf, "graded_docs")).select("column", "pct")


def _label_sql(skew, kurt, n_unique):
    return f"""case when {n_unique} = 0 then 'unknown' when {n_unique} <= 2 then 'binary' when {n_unique} <= 10 then 'discrete-low-cardinality'
      when abs({skew}) < 0.5 and abs({kurt}) < 1.0 then 'normal' when {skew} > 1.0 then 'right-skewed' when {skew} < -1.0 then 'left-skewed'
      when {kurt} < -1.2 and abs({skew}) < 0.5 then 'uniform' when {kurt} > 3.0 and abs({skew}) < 0.5 then 'possibly-bimodal' else 'moderate-skew' end"""


def _tails_sql(skew, kurt, sd):
    return f"""case when {sd} < 0.01 then 'constant' when abs({skew}) < 0.5 then (case when abs({kurt}) < 0.5 then 'normal' when {kurt} > 0 then 'leptokurtic' else 'platykurtic' end)
      when {skew} > 1 then 'right_skewed' when {skew} < -1 then 'left_skewed' else 'moderately_skewed' end"""


def _profile_sql(c, t):
    q = lambda p: f"quantile_cont({c}, {p})"
    return f"""select '{c}' as "column", count(*) as n_total, count(*) - count({c}) as n_null, (count(*) - count({c})) / count(*)::double as null_pct,
      count(*) filter ({c} = 0) as n_zero, count(distinct {c}) as n_unique, avg({c}) as mean, median({c}) as median,
      (select {c} from {t} where {c} is not null group by 1 order by count(*) desc, 1 limit 1) as "mode", stddev_samp({c}) as std, var_samp({c}) as variance,
      min({c}) as "min", max({c}) as "max", max({c}) - min({c}) as "range", {q(0.01)} as p1, {q(0.05)} as p5, {q(0.25)} as p25, {q(0.75)} as p75, {q(0.95)} as p95, {q(0.99)} as p99,
      {q(0.75)} - {q(0.25)} as iqr, {_b1(c)} as skewness, {_b2(c)} as kurtosis, stddev_samp({c}) / avg({c}) as cv,
      (select count(*) from {t}, (select {q(0.25)} as a, {q(0.75)} as b from {t}) f where {c} < a - 1.5 * (b - a) or {c} > b + 1.5 * (b - a)) as n_iqr_outliers,
      {_label_sql(_b1(c), _b2(c), f'count(distinct {c})')} as distribution from {t}"""


_PROFILE_DOUBLES = 'null_pct, mean, median, "mode", std, variance, "min", "max", "range", p1, p5, p25, p75, p95, p99, iqr, skewness, kurtosis, cv'


@query("full_profile", r(union_all([_profile_sql(c, _WIDE) for c in _WIDE_NUM]), _PROFILE_DOUBLES, 3))
def full_profile(spark, sf):
    return tidy(stats.full_profile(derived(spark, sf, "wide_lines"), _WIDE_NUM), 3)


@query("full_profile_events", r(_profile_sql("v", dsql("gappy_events")), _PROFILE_DOUBLES, 3))
def full_profile_events(spark, sf):
    return tidy(stats.full_profile(derived(spark, sf, "gappy_events"), ["v"]), 3)


@query(
    "profile_v2",
    r(
        f"""select 'price' as "column", 'numeric' as dtype, count(*) as "count", count(*) - count(price) as null_count, count(distinct price) as "unique",
        avg(price) as mean, median(price) as median, stddev_samp(price) as std, min(price) as "min", max(price) as "max", quantile_cont(price, 0.25) as q25,
        quantile_cont(price, 0.75) as q75, quantile_cont(price, 0.75) - quantile_cont(price, 0.25) as iqr, {_b1('price')} as skewness, {_b2('price')} as kurtosis,
        null::varchar as "mode", {_tails_sql(_b1('price'), _b2('price'), 'stddev_samp(price)')} as distribution from {dsql('rough_orders')}
        union all select 'prio', 'categorical', count(*), count(*) - count(prio), count(distinct prio), null, null, null, null, null, null, null, null, null, null,
        (select prio from {dsql('rough_orders')} where prio is not null group by 1 order by count(*) desc, 1 limit 1), 'categorical' from {dsql('rough_orders')}""",
        'mean, median, std, "min", "max", q25, q75, iqr, skewness, kurtosis',
    ),
)
def profile_v2(spark, sf):
    return tidy(stats.profile_mixed(derived(spark, sf, "rough_orders").select("price", "prio")))


_SHAPES = union_all(
    [f"""select '{c}' as "column", {_label_sql(_b1(c), _b2(c), f'count(distinct {c})')} as distribution from {t}""" for c, t in
     [("qty", _WIDE), ("price", _WIDE), ("disc", _WIDE), ("tax", _WIDE)]]
)


@query("distribution_label", _SHAPES)
def distribution_label(spark, sf):
    return stats.distribution_labels(derived(spark, sf, "wide_lines"), _WIDE_NUM)


@query(
    "distribution_label_v2",
    union_all([f"""select '{c}' as "column", {_tails_sql(_b1(c), _b2(c), f'stddev_samp({c})')} as distribution from {_WIDE}""" for c in _WIDE_NUM])
    + f""" union all select 'konst', case when stddev_samp(konst) < 0.01 then 'constant' else 'other' end from {_WIDE}""",
)
def distribution_label_v2(spark, sf):
    return stats.distribution_labels(derived(spark, sf, "wide_lines"), [*_WIDE_NUM, "konst"], "tails")


@query("distribution_breakdown", f"select distribution, count(*) as n_columns from ({_SHAPES}) group by 1")
def distribution_breakdown(spark, sf):
    return stats.distribution_breakdown(derived(spark, sf, "wide_lines"), _WIDE_NUM)


def _moments_sql(c, t):
    return f"""select '{c}' as "column", count({c}) as n, skewness({c}) as skew_g1, {_b1(c)} as skew_b1, kurtosis({c}) as kurt_g2, {_b2(c)} as kurt_b2 from {t}"""


@query("moments", r(union_all([_moments_sql(c, _WIDE) for c in _WIDE_NUM] + [_moments_sql("value", "events")][:0]), "skew_g1, skew_b1, kurt_g2, kurt_b2"))
def moments(spark, sf):
    return tidy(stats.moments(derived(spark, sf, "wide_lines"), _WIDE_NUM))


@query(
    "percentiles",
    r(per(_WIDE_NUM, 'select \'{c}\' as "column", quantile_cont({c}, 0.01) as p1, quantile_cont({c}, 0.05) as p5, quantile_cont({c}, 0.25) as p25, quantile_cont({c}, 0.75) as p75, quantile_cont({c}, 0.95) as p95, quantile_cont({c}, 0.99) as p99 from {t}', _WIDE), "p1, p5, p25, p75, p95, p99"),
)
def percentiles(spark, sf):
    return tidy(stats.percentiles(derived(spark, sf, "wide_lines"), _WIDE_NUM))


@query(
    "percentiles_narrowing",
    r(per(["value"], 'select \'{c}\' as "column", quantile_cont({c}, 0.05) as p5, quantile_cont({c}, 0.5) as p50, quantile_cont({c}, 0.95) as p95 from {t}', "events"), "p5, p50, p95"),
)
def percentiles_narrowing(spark, sf):
    """The large-table route of the exact quantiles, forced."""
    q = stats.exact_quantiles(load(spark, sf, "events"), ["value"], [0.05, 0.5, 0.95], exact_cells=0, bracket_rows=50)
    return tidy(stats.local(load(spark, sf, "events"), q, "`column` string, p5 double, p50 double, p95 double"))


@query(
    "column_info",
    r(
        union_all(
            [
                f"""select '{c}' as "column", '{t}' as dtype, count(*) - count({c}) as null_count, round((count(*) - count({c})) * 100.0 / count(*), 2) as null_pct,
                count(distinct {c}) as n_unique, round(count(distinct {c}) * 100.0 / count(*), 2) as unique_pct,
                (select cast({c} as varchar) from {dsql('rough_orders')} where {c} is not null order by o_orderkey limit 1) as sample from {dsql('rough_orders')}"""
                for c, t in [("o_orderkey", "bigint"), ("prio", "string"), ("numtext", "string")]
            ]
        ),
        "null_pct, unique_pct",
        2,
    ),
)
def column_info(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_orderkey", "prio", "numtext")
    return tidy(stats.column_info(df, ["o_orderkey"]), 2)


@query(
    "column_type_counts",
    """select semantic, count(*) as n from (
       select * from (values ('id'), ('categorical'), ('categorical')) v(semantic)
       union all select case when count(distinct c_nationkey) >= count(*) * 0.1 then 'id' else 'numeric' end from customer
       union all select case when count(distinct c_acctbal) > 10 and count(distinct c_acctbal) >= count(*) * 0.1 and max(c_acctbal) > 2 * count(distinct c_acctbal) then 'id' else 'numeric' end from customer) group by 1""",
)
def column_type_counts(spark, sf):
    return ty.detect_column_type(load(spark, sf, "customer")).groupBy("semantic").agg(F.count(F.lit(1)).alias("n"))


@query(
    "health_scores",
    r(
        f"""select 100 - round(((count(*) - count(price)) + (count(*) - count(prio))) * 100.0 / (count(*) * 3), 2) as completeness,
        100 - round((count(*) - (select count(*) from (select distinct o_custkey, price, prio from {dsql('rough_orders')}))) * 100.0 / count(*), 2) as uniqueness,
        1::bigint as complete_columns, 3::bigint as n_columns from {dsql('rough_orders')}""",
        "completeness, uniqueness",
        2,
    ),
)
def health_scores(spark, sf):
    return tidy(stats.health_scores(derived(spark, sf, "rough_orders").select("o_custkey", "price", "prio")), 2)


@query("entropy", r("select -sum(p * log2(p)) as entropy from (select count(*) / sum(count(*)) over () as p from part group by p_brand)", "entropy"))
def entropy(spark, sf):
    return tidy(stats.entropy(load(spark, sf, "part"), "p_brand"))


@query("class_balance", r('select quality as value, count(*) as "count", count(*) / sum(count(*)) over () as share from labels group by 1', "share"))
def class_balance(spark, sf):
    return tidy(stats.class_balance(load(spark, sf, "labels"), "quality"))


@query(
    "run_summary",
    f"""with d as (select * from {dsql('rough_orders')}) select 'cleaning' as stage, 'rows_before' as item, cast(count(*) as varchar) as value from d
        union all select 'cleaning', 'rows_after', cast(count(*) as varchar) from (select distinct * from d)
        union all select 'cleaning', 'rows_removed', cast((select count(*) from d) - count(*) as varchar) from (select distinct * from d)
        union all select 'cleaning', 'dropped_high_null', '[''sparse'']' union all select 'cleaning', 'dropped_constant', '[''konst'']'
        union all select 'missing', 'filled', '2' union all select 'type', 'boolean', '[''flag'']' union all select 'encoding', 'encoded', '1'""",
)
def run_summary(spark, sf):
    """Rows before and after, duplicates, dropped, filled and encoded columns."""
    cfg = PrepConfig(keys=["o_orderkey", "o_custkey"], stages=["cleaning", "type", "missing", "encoding"])
    out = runs.preprocess_only(derived(spark, sf, "rough_orders").drop("numtext", "spiky"), cfg)
    wanted = ["rows_before", "rows_after", "rows_removed", "dropped_high_null", "dropped_constant", "filled", "boolean", "encoded"]
    return out.summary_table().where(F.col("item").isin(wanted))


@query("most_skewed", r(f"select * from (select \"column\", skew_b1 as skewness from ({_moments_sql('v', dsql('gappy_events'))})) where abs(skewness) > 0.5", "skewness"))
def most_skewed(spark, sf):
    df = derived(spark, sf, "gappy_events").select("v", F.col("event_id").cast("double").alias("event_id"))
    return tidy(stats.most_skewed(df, ["v", "event_id"]))


@query(
    "sorted_gap_stats",
    r("""select 'c_acctbal' as "column", stddev_pop(gap) / (avg(gap) + 1e-10) as gap_ratio from (select v - lag(v) over (order by v) as gap from (select distinct c_acctbal as v from customer order by 1 limit 100))""", "gap_ratio"),
)
def sorted_gap_stats(spark, sf):
    from millrace.operators import clean

    return tidy(clean.id_report(load(spark, sf, "customer"), ["c_acctbal"]).select("column", "gap_ratio"))


# ---- outliers -----------------------------------------------------------------

_SPIKY = dsql("rough_orders")


def _fence_sql(c, t, method):
    iqr = f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as lo, quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as hi"
    z = f"avg({c}) - 3 * stddev_samp({c}) as lo, avg({c}) + 3 * stddev_samp({c}) as hi"
    if method == "iqr":
        return f"(select {iqr} from {t})"
    if method == "zscore":
        return f"(select {z} from {t})"
    if method == "both":
        return f"(select least(a.lo, b.lo) as lo, greatest(a.hi, b.hi) as hi from (select {iqr} from {t}) a, (select {z} from {t}) b)"
    return f"(select case when sk > 1 then i.lo else z.lo end as lo, case when sk > 1 then i.hi else z.hi end as hi from (select {iqr} from {t}) i, (select {z} from {t}) z, (select abs(skewness({c})) as sk from {t}) s)"


def _outlier_row(c, t, method, strategy, label=None):
    return f"""select '{c}' as "column", {label or f"'{method}'"} as method, '{strategy}' as strategy, lo as lower_bound, hi as upper_bound, count({c}) as n,
      count(*) filter ({c} < lo or {c} > hi) as "count", count(*) filter ({c} < lo or {c} > hi) * 100.0 / count({c}) as pct from {t}, {_fence_sql(c, t, method)} f group by lo, hi"""


def _report(spark, sf, method):
    df = derived(spark, sf, "rough_orders")
    return tidy(outliers.outlier_report(df, outliers.fit_outliers(df, ["spiky", "price"], method, "none")))


for _m in ("iqr", "zscore", "both"):
    query(f"outlier_{_m}", r(union_all([_outlier_row(c, _SPIKY, _m, "none") for c in ("spiky", "price")]), "lower_bound, upper_bound, pct"))(
        lambda spark, sf, m=_m: _report(spark, sf, m)
    )


@query(
    "outlier_auto_method",
    r(union_all([_outlier_row(c, _SPIKY, "auto", "none", f"(select case when abs(skewness({c})) > 1 then 'iqr' else 'zscore' end from {_SPIKY})") for c in ("spiky", "price")]), "lower_bound, upper_bound, pct"),
)
def outlier_auto_method(spark, sf):
    return _report(spark, sf, "auto")


def _treat(spark, sf, strategy, cols=("o_orderkey", "spiky")):
    df = derived(spark, sf, "rough_orders").select(*cols)
    return tidy(outliers.fit_outliers(df, ["spiky"], "iqr", strategy).transform(df))


_F = _fence_sql("spiky", _SPIKY, "iqr")


@query("outlier_clip", r(f"select o_orderkey, greatest(least(spiky, hi), lo) as spiky from {_SPIKY}, {_F} f", "spiky"))
def outlier_clip(spark, sf):
    return _treat(spark, sf, "clip")


@query("outlier_drop", r(f"select o_orderkey, spiky from {_SPIKY}, {_F} f where spiky between lo and hi", "spiky"))
def outlier_drop(spark, sf):
    return _treat(spark, sf, "drop")


@query("outlier_flag", r(f"select o_orderkey, spiky, case when spiky < lo or spiky > hi then 1 else 0 end as spiky_is_outlier from {_SPIKY}, {_F} f", "spiky"))
def outlier_flag(spark, sf):
    return _treat(spark, sf, "flag")


@query("outlier_impute", r(f"select o_orderkey, case when spiky < lo or spiky > hi then (select median(spiky) from {_SPIKY}) else spiky end as spiky from {_SPIKY}, {_F} f", "spiky"))
def outlier_impute(spark, sf):
    return _treat(spark, sf, "impute")


@query(
    "outlier_overrides",
    r(union_all([_outlier_row("spiky", _SPIKY, "zscore", "flag"), _outlier_row("price", _SPIKY, "iqr", "clip")]), "lower_bound, upper_bound, pct"),
)
def outlier_overrides(spark, sf):
    df = derived(spark, sf, "rough_orders")
    step = outliers.fit_outliers(
        df, ["spiky", "price", "sparse"], "iqr", "clip", overrides={"spiky": {"method": "zscore", "strategy": "flag"}}, skip=["sparse"]
    )
    return tidy(outliers.outlier_report(df, step))


@query("outlier_report", r(union_all([_outlier_row(c, "lineitem", "iqr", "clip") for c in NUM]), "lower_bound, upper_bound, pct"))
def outlier_report(spark, sf):
    df = load(spark, sf, "lineitem")
    return tidy(outliers.outlier_report(df, outliers.fit_outliers(df, NUM, "iqr")).orderBy(F.desc("pct"), "column"))


# ---- chart data ---------------------------------------------------------------


def _hist_sql(c, t, k):
    return f"""select '{c}' as "column", i::int as bin, mn + i * w as lower, mn + (i + 1) * w as upper, coalesce(n, 0)::bigint as "count" from
      (select min({c}) as mn, (max({c}) - min({c})) / {k} as w from {t}) s, range({k}) g(i)
      left join (select least(floor(({c} - mn) / w), {k} - 1)::bigint as b, count(*) as n from {t}, (select min({c}) as mn, (max({c}) - min({c})) / {k} as w from {t}) q where {c} is not null group by 1) h on h.b = i"""


@query("histogram", r(union_all([_hist_sql(c, _WIDE, 30) for c in ("qty", "price")]), "lower, upper"))
def histogram(spark, sf):
    return tidy(chartdata.histogram(derived(spark, sf, "wide_lines"), ["qty", "price"], 30))


@query(
    "kde",
    r(
        """with s as (select min(value) as mn, max(value) as mx, count(value)::double as n, stddev_samp(value) * pow(count(value), -0.2) as h from events),
        b as (select mn + (least(floor((value - mn) / ((mx - mn) / 512)), 511) + 0.5) * ((mx - mn) / 512) as m, count(*)::double as w from events, s where value is not null group by 1)
        select x, sum(w * exp(-pow((x - m) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())) as density
        from (select i, (mn - 3 * h) + i * ((mx - mn + 6 * h) / 99) as x, n, h from s, range(100) g(i)) g, b group by i, x""",
        "x, density",
        6,
    ),
)
def kde(spark, sf):
    return tidy(chartdata.kde(load(spark, sf, "events"), "value"), 6)


def _box_sql(c, t):
    return f"""select '{c}' as "column", q1, median, q3, min({c}) filter ({c} between lo and hi) as whisker_low, max({c}) filter ({c} between lo and hi) as whisker_high,
      count(*) filter ({c} < lo or {c} > hi) as n_outliers from {t}, (select quantile_cont({c}, 0.25) as q1, median({c}) as median, quantile_cont({c}, 0.75) as q3,
      q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from {t}) f group by q1, median, q3"""


@query("box_stats", r(union_all([_box_sql(c, _SPIKY) for c in ("spiky", "price")]), "q1, median, q3, whisker_low, whisker_high"))
def box_stats(spark, sf):
    return tidy(chartdata.box_stats(derived(spark, sf, "rough_orders"), ["spiky", "price"]))


@query(
    "box_points",
    r(f"""select 'spiky' as "column", spiky as value, rank::int as rank from (select spiky, row_number() over (order by greatest(lo - spiky, spiky - hi) desc, spiky) as rank
       from {_SPIKY}, {_F} f where spiky < lo or spiky > hi) where rank <= 50""", "value"),
)
def box_points(spark, sf):
    return tidy(chartdata.box_points(derived(spark, sf, "rough_orders"), ["spiky"], 50))


def corr_sql(a, b, t):
    return f"select '{a}' as col_a, '{b}' as col_b, case when isnan(corr({a}, {b})) then null else corr({a}, {b}) end as value from {t}"


def matrix_sql(cols, t):
    off = [corr_sql(a, b, t) for a in cols for b in cols if a != b]
    return union_all(off + [f"select '{c}', '{c}', 1.0::double" for c in cols])


@query(
    "corr_heatmap",
    r(f"""select list_position({NUM}, col_a)::int - 1 as "row", list_position({NUM}, col_b)::int - 1 as col, col_a, col_b, value from ({matrix_sql(NUM, 'lineitem')})
       where list_position({NUM}, col_b) <= list_position({NUM}, col_a)""", "value"),
)
def corr_heatmap(spark, sf):
    return tidy(chartdata.corr_heatmap(load(spark, sf, "lineitem"), NUM, lower=True))


@query("category_bars", f"""select "column", value, "count", rank::int as rank from ({_top_sql('part', ['p_type', 'p_brand'], 15)})""")
def category_bars(spark, sf):
    return chartdata.category_bars(load(spark, sf, "part"), ["p_type", "p_brand", "p_name"])


@query(
    "category_shares",
    r(union_all([f"""select '{c}' as "column", {c} as value, count(*) as "count", count(*) / sum(count(*)) over () as share from orders group by {c}""" for c in ("o_orderstatus", "o_orderpriority")]), "share"),
)
def category_shares(spark, sf):
    return tidy(chartdata.category_shares(load(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]))


_FRACTION = "cast('0x' || substr(md5(concat_ws(':', cast({k} as varchar), '42')), 1, 8) as bigint)"


@query(
    "scatter_sample",
    f"select event_id, value as x, cast(user_id as double) as y from events where (select count(*) from events) <= 5000 or {_FRACTION.format(k='event_id')} < 5000.0 / (select count(*) from events) * 4294967296",
)
def scatter_sample(spark, sf):
    return chartdata.scatter_sample(load(spark, sf, "events"), "value", "user_id", ["event_id"])


@query(
    "scatter_trend",
    r("select 'l_quantity' as x, 'l_extendedprice' as y, regr_slope(l_extendedprice, l_quantity) as slope, regr_intercept(l_extendedprice, l_quantity) as intercept, count(*) as n, corr(l_quantity, l_extendedprice) as r from lineitem", "slope, intercept, r"),
)
def scatter_trend(spark, sf):
    return tidy(chartdata.scatter_trend(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@query(
    "pair_grid",
    union_all(
        [
            f"select p_partkey, '{a}' as col_x, '{b}' as col_y, cast({a} as double) as x, cast({b} as double) as y, p_type as hue from part where (select count(*) from part) <= 5000 or {_FRACTION.format(k='p_partkey')} < 5000.0 / (select count(*) from part) * 4294967296"
            for a, b in [("p_size", "p_retailprice")]
        ]
    ),
)
def pair_grid(spark, sf):
    return chartdata.pair_grid(load(spark, sf, "part"), ["p_size", "p_retailprice"], ["p_partkey"], hue="p_type")


def _group_sql(name, a, b, t, k):
    diag = union_all([_hist_sql(c, t, k) for c in (a, b)])
    return f"""select '{name}' as "group", 'histogram' as kind, "column" as col_a, null::varchar as col_b, bin, "count"::double as value from ({diag})
      union all select '{name}', 'r', '{a}', '{b}', null, corr({a}, {b}) from {t}"""


@query("relationship_groups", r(union_all([_group_sql("amounts", "l_quantity", "l_extendedprice", "lineitem", 20), _group_sql("rates", "l_discount", "l_tax", "lineitem", 20)]), "value"))
def relationship_groups(spark, sf):
    groups = {"amounts": ["l_quantity", "l_extendedprice"], "rates": ["l_discount", "l_tax"]}
    return tidy(chartdata.relationship_groups(load(spark, sf, "lineitem"), groups))


@query(
    "chart_spec",
    r(
        f"""select 'histogram' as chart, "column" as a, null::varchar as b, cast(bin as varchar) as item, "count"::double as value from ({_hist_sql('c_acctbal', 'customer', 30)})
        union all select 'box', "column", null, unnest(['q1', 'median', 'q3', 'whisker_low', 'whisker_high', 'n_outliers']), unnest([q1, median, q3, whisker_low, whisker_high, n_outliers::double]) from ({_box_sql('c_acctbal', 'customer')})
        union all select 'scatter', 'c_nationkey', 'c_acctbal', unnest(['slope', 'intercept', 'r']), unnest([regr_slope(c_acctbal, c_nationkey), regr_intercept(c_acctbal, c_nationkey), corr(c_acctbal, c_nationkey)]) from customer
        union all select 'heatmap', col_a, col_b, 'r', value from ({matrix_sql(['c_nationkey', 'c_acctbal'], 'customer')})""",
        "value",
    ),
)
def chart_spec(spark, sf):
    df = load(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    spec = {"histogram": ["c_acctbal"], "box": ["c_acctbal"], "scatter": [("c_nationkey", "c_acctbal")], "heatmap": True}
    return tidy(chartdata.chart_spec(df, spec))


@query("report_tables")
def report_tables(spark, sf):
    """Every section of the report, written below one folder."""
    from millrace.session import scratch_dir
    from millrace.sources.writers import write_tables

    df = load(spark, sf, "orders").select("o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")
    tables = runs.report_tables(df)
    path = scratch_dir(spark, "report")
    names = write_tables(tables, path)
    rows = [(n, spark.read.parquet(f"{path}/{n}").count()) for n in names]
    return spark.createDataFrame(rows, "section string, n_rows bigint")


@query(
    "strength_labels",
    """select o_orderpriority as grp, r, case when abs(r) >= 0.8 then 'very strong' when abs(r) >= 0.6 then 'strong' when abs(r) >= 0.4 then 'moderate' when abs(r) >= 0.2 then 'weak' else 'very weak' end as strength,
       case when r > 0 then 'positive' else 'negative' end as direction,
       case when abs(r) >= 0.14 then 'strong' when abs(r) >= 0.06 then 'moderate' when abs(r) >= 0.01 then 'weak' else 'very weak' end as eta_band,
       case when abs(r) >= 0.5 then 'very strong' when abs(r) >= 0.3 then 'strong' when abs(r) >= 0.1 then 'moderate' when abs(r) >= 0.05 then 'weak' else 'very weak' end as v_band
       from (select o_orderpriority, o_orderkey % 201 / 100.0::double - 1 as r from orders group by 1, 2)""",
)
def strength_labels(spark, sf):
    grid = load(spark, sf, "orders").select(F.col("o_orderpriority").alias("grp"), (F.col("o_orderkey") % 201 / F.lit(100.0) - 1).alias("r")).distinct()
    size = F.abs("r")
    return grid.select(
        "grp", "r", labels.band(size, labels.CORRELATION_BANDS).alias("strength"), labels.direction(F.col("r")).alias("direction"),
        labels.band(size, labels.ETA_BANDS).alias("eta_band"), labels.band(size, labels.CRAMERS_BANDS).alias("v_band"),
    )



