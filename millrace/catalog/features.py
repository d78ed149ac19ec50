"""Scaling, derived columns, ranks, fitted plans on batch and stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy
from millrace.operators import features, impute, outliers
from millrace.plans.fitted import FittedPlan
from millrace.streaming import apply as stream

W = dsql("wide_lines")
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
K = ", ".join(KEYS)


def _lines(spark, sf, *cols):
    return derived(spark, sf, "wide_lines").select(*KEYS, *cols)


def _scale(spark, sf, how, **kw):
    df = _lines(spark, sf, "qty", "konst")
    return tidy(features.fit_scale(df, ["qty", "konst"], how, **kw).transform(df), 6)


def _scale_sql(expr, const="0.0"):
    return r(f"select {K}, {expr} as qty, {const}::double as konst from {W}, (select avg(qty) as m, stddev_pop(qty) as sp, stddev_samp(qty) as ss, min(qty) as mn, max(qty) as mx, median(qty) as md, quantile_cont(qty, 0.75) - quantile_cont(qty, 0.25) as iqr from {W}) s", "qty, konst", 6)


@query("scale_minmax", _scale_sql("(qty - mn) / (mx - mn)"))
def scale_minmax(spark, sf):
    return _scale(spark, sf, "minmax")


@query("scale_minmax_keep", _scale_sql("(qty - mn) / (mx - mn)", "1.0"))
def scale_minmax_keep(spark, sf):
    return _scale(spark, sf, "minmax", constant="keep")


@query("scale_standard", _scale_sql("(qty - m) / sp"))
def scale_standard(spark, sf):
    return _scale(spark, sf, "standard")


@query("scale_standard_sample", _scale_sql("(qty - m) / ss"))
def scale_standard_sample(spark, sf):
    return _scale(spark, sf, "standard", ddof=1)


@query("scale_robust", _scale_sql("(qty - md) / iqr"))
def scale_robust(spark, sf):
    return _scale(spark, sf, "robust")


@query("scale_auto", _scale_sql("case when ss / abs(m) > 0.5 then (qty - md) / iqr else (qty - m) / sp end"))
def scale_auto(spark, sf):
    return _scale(spark, sf, "auto")


@query(
    "log_transform_skewed",
    r("""select event_id, case when mn > 0 and abs(sk) > 1 then ln(1 + value) else value end as value from events,
       (select min(value) as mn, skewness(value) as sk from events) s""", "value", 6),
)
def log_transform_skewed(spark, sf):
    df = load(spark, sf, "events").select("event_id", "value")
    return tidy(features.fit_log_skewed(df, ["value"]).transform(df), 6)


def _rule(spark, sf, rule, keep, digits=4):
    df = _lines(spark, sf, "qty", "price", "disc", "tax")
    return tidy(features.add_features(df, [rule]).select(*KEYS, *keep), digits)


def _rule_sql(exprs: dict, digits=4, extra=""):
    cols = ", ".join(f"{e} as {n}" for n, e in exprs.items())
    return r(f"select {K}, {cols} from {W}{extra}", ", ".join(exprs), digits)


@query("feat_ratio", _rule_sql({"price_div_tax": "price / nullif(tax, 0)"}))
def feat_ratio(spark, sf):
    return _rule(spark, sf, {"type": "ratio", "col_a": "price", "col_b": "tax"}, ["price_div_tax"])


@query("feat_ratio_zero_as_one", _rule_sql({"q": "coalesce(qty / coalesce(nullif(tax, 0), 1), 0)"}))
def feat_ratio_zero_as_one(spark, sf):
    return _rule(spark, sf, {"type": "ratio", "col_a": "qty", "col_b": "tax", "zero": "one", "name": "q"}, ["q"])


@query("feat_diff", _rule_sql({"price_minus_qty": "price - qty"}))
def feat_diff(spark, sf):
    return _rule(spark, sf, {"type": "diff", "col_a": "price", "col_b": "qty"}, ["price_minus_qty"])


@query("feat_product", _rule_sql({"price_x_disc": "price * disc"}))
def feat_product(spark, sf):
    return _rule(spark, sf, {"type": "product", "col_a": "price", "col_b": "disc"}, ["price_x_disc"])


_CELLS = ["qty", "disc", "tax"]


@query("feat_row_mean", _rule_sql({"agg_mean": "(coalesce(qty, 0) + disc + tax) / (2 + case when qty is null then 0 else 1 end)"}))
def feat_row_mean(spark, sf):
    return _rule(spark, sf, {"type": "agg_mean", "cols": _CELLS}, ["agg_mean"])


@query("feat_row_sum", _rule_sql({"agg_sum": "coalesce(qty, 0) + disc + tax"}))
def feat_row_sum(spark, sf):
    return _rule(spark, sf, {"type": "agg_sum", "cols": _CELLS}, ["agg_sum"])


@query("feat_row_max_min", _rule_sql({"hi": "greatest(qty, disc, tax)", "lo": "least(qty, disc, tax)"}))
def feat_row_max_min(spark, sf):
    df = _lines(spark, sf, *_CELLS)
    rules = [{"type": "agg_max", "cols": _CELLS, "name": "hi"}, {"type": "agg_min", "cols": _CELLS, "name": "lo"}]
    return tidy(features.add_features(df, rules).select(*KEYS, "hi", "lo"))


_STD_ALG = "list_aggregate([qty, disc, tax], 'stddev_samp')"


@query("feat_row_std", _rule_sql({"agg_std": _STD_ALG}))
def feat_row_std(spark, sf):
    return _rule(spark, sf, {"type": "agg_std", "cols": _CELLS}, ["agg_std"])


@query("feat_log1p", _rule_sql({"qty_log1p": "ln(1 + case when qty < 0 then 0 else qty end)"}))
def feat_log1p(spark, sf):
    return _rule(spark, sf, {"type": "log1p", "col": "qty"}, ["qty_log1p"])


@query("feat_square", _rule_sql({"qty_sq": "qty * qty"}))
def feat_square(spark, sf):
    return _rule(spark, sf, {"type": "square", "col": "qty"}, ["qty_sq"])


@query("feat_sqrt", _rule_sql({"price_sqrt": "sqrt(greatest(price, 0))"}))
def feat_sqrt(spark, sf):
    return _rule(spark, sf, {"type": "sqrt", "col": "price"}, ["price_sqrt"])


@query("feat_polynomial", _rule_sql({"qty_sq": "pow(qty, 2)", "qty_cub": "pow(qty, 3)"}))
def feat_polynomial(spark, sf):
    return _rule(spark, sf, {"type": "polynomial", "col": "qty"}, ["qty_sq", "qty_cub"])


@query("feat_zscore", _rule_sql({"qty_zscore": "(qty - m) / (s + 1e-9)"}, 6, f", (select avg(qty) as m, stddev_samp(qty) as s from {W}) z"))
def feat_zscore(spark, sf):
    return _rule(spark, sf, {"type": "zscore", "col": "qty"}, ["qty_zscore"], 6)


@query("feat_bin", f"select {K}, greatest(ceil((qty - mn) / ((mx - mn) / 5)) - 1, 0)::int * (qty / qty)::int as qty_bin from {W}, (select min(qty) as mn, max(qty) as mx from {W}) s")
def feat_bin(spark, sf):
    return _rule(spark, sf, {"type": "bin", "col": "qty", "n_bins": 5}, ["qty_bin"])


@query(
    "feat_rank_pct",
    r(f"""select {K}, case when qty is not null then (rank() over (order by qty nulls last) + (count(*) over (partition by qty) - 1) / 2.0) / n end as qty_rank
       from {W}, (select count(qty) as n from {W}) s""", "qty_rank", 6),
)
def feat_rank_pct(spark, sf):
    return _rule(spark, sf, {"type": "rank", "col": "qty"}, ["qty_rank"], 6)


@query(
    "feat_rank_pct_chunked",
    r("select event_id, (rank() over (order by value) + (count(*) over (partition by value) - 1) / 2.0) / count(*) over () as value_rank from events", "value_rank", 6),
)
def feat_rank_pct_chunked(spark, sf):
    """The route for many distinct values, forced: ranks per value range."""
    df = load(spark, sf, "events").select("event_id", "value")
    ranked = features.with_avg_rank(df, "value", "rank", few=0)
    return tidy(ranked.select("event_id", (F.col("rank") / F.lit(float(df.count()))).alias("value_rank")), 6)


@query(
    "feat_rank_pct_heavy",
    r("select event_id, (rank() over (order by v) + (count(*) over (partition by v) - 1) / 2.0) / count(*) over () as v_rank from (select event_id, case when event_id % 2 = 0 then 50 else value end as v from events)", "v_rank", 6),
)
def feat_rank_pct_heavy(spark, sf):
    """Half of all rows share one value."""
    df = load(spark, sf, "events").selectExpr("event_id", "case when event_id % 2 = 0 then 50 else value end as v")
    ranked = features.with_avg_rank(df, "v", "rank", few=0)
    return tidy(ranked.select("event_id", (F.col("rank") / F.lit(float(df.count()))).alias("v_rank")), 6)


@query("feat_interactions", _rule_sql({"qty_x_price": "qty * price", "qty_x_disc": "qty * disc", "price_x_disc": "price * disc"}))
def feat_interactions(spark, sf):
    df = _lines(spark, sf, "qty", "price", "disc")
    return tidy(features.interactions(df, ["qty", "price", "disc"]).select(*KEYS, "qty_x_price", "qty_x_disc", "price_x_disc"))


@query(
    "feat_row_stats",
    _rule_sql({
        "_row_mean": "(coalesce(qty, 0) + disc + tax) / (2 + case when qty is null then 0 else 1 end)", "_row_std": _STD_ALG,
        "_row_min": "least(qty, disc, tax)", "_row_max": "greatest(qty, disc, tax)",
    }),
)
def feat_row_stats(spark, sf):
    df = _lines(spark, sf, *_CELLS)
    return tidy(features.row_stats(df, _CELLS).select(*KEYS, "_row_mean", "_row_std", "_row_min", "_row_max"))


@query("feat_rules", _rule_sql({"qty_sq": "qty * qty", "price_div_tax": "price / nullif(tax, 0)", "two": "coalesce(qty, 0) + disc"}))
def feat_rules(spark, sf):
    df = _lines(spark, sf, "qty", "price", "disc", "tax")
    rules = [
        {"type": "square", "col": "qty"}, {"type": "ratio", "col_a": "price", "col_b": "tax"},
        {"type": "diff", "col_a": "price", "col_b": "missing_column"},
        {"type": "agg_sum", "cols": ["qty", "disc", "missing_column"], "name": "two"},
    ]
    return tidy(features.add_features(df, rules).select(*KEYS, "qty_sq", "price_div_tax", "two"))


# ---- a fitted plan on batch and stream ----------------------------------------

_APPLY_SQL = r(
    """with b as (select event_id, event_type, case when event_id % 3 = 0 then null else value end as v from events),
       q as (select median(v) as md from b), f as (select b.*, coalesce(v, md) as x from b, q),
       g as (select quantile_cont(x, 0.25) - 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) as lo, quantile_cont(x, 0.75) + 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) as hi from f),
       c as (select event_id, greatest(least(x, hi), lo) as x from f, g)
       select event_id, (x - (select avg(x) from c)) / (select stddev_pop(x) from c) as v from c""",
    "v",
)


def _fitted(df):
    fill = impute.fit_impute(df, {"v": "median"})
    filled = fill.transform(df)
    clip = outliers.fit_outliers(filled, ["v"], "iqr", "clip")
    return FittedPlan([fill, clip, features.fit_scale(clip.transform(filled), ["v"], "standard")])


@query("apply_fitted", _APPLY_SQL)
def apply_fitted(spark, sf):
    df = derived(spark, sf, "gappy_events").select("event_id", "v")
    return tidy(stream.apply_fitted(df, _fitted(df)))


@query("apply_fitted_stream", _APPLY_SQL)
def apply_fitted_stream(spark, sf):
    """The same plan on a file stream, drained into a table."""
    batch = derived(spark, sf, "gappy_events").select("event_id", "v")
    plan = _fitted(batch)
    events = stream.read_stream(spark, sf, spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").schema, glob="events.parquet")
    rows = events.selectExpr("event_id", "case when event_id % 3 = 0 then null else value end as v")
    return tidy(stream.run_to_table(stream.apply_fitted(rows, plan)))
