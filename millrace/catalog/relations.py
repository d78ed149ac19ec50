"""Correlation, tests, mutual information, selection, recommendations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from millrace.catalog.base import derived, dsql, load, query, r, tidy, union_all
from millrace.catalog.profiling import corr_sql, matrix_sql
from millrace.operators import recommend, relate, select
from millrace.plans import run as runs
from millrace.plans.config import PrepConfig

W = dsql("wide_lines")
WNUM = ["qty", "price", "price_up", "disc", "tax"]


def _wide(spark, sf, *cols):
    return derived(spark, sf, "wide_lines").select(*cols)


@query("pearson_matrix", r(matrix_sql([*WNUM, "konst"], W), "value"))
def pearson_matrix(spark, sf):
    return tidy(relate.corr_matrix(_wide(spark, sf, *WNUM, "konst")))


@query("pearson_matrix_wide", r(matrix_sql([*WNUM, "konst"], W), "value"))
def pearson_matrix_wide(spark, sf):
    """The route for many columns, forced: one pass of masked Gram matrices."""
    cols = [*WNUM, "konst"]
    df = _wide(spark, sf, *cols)
    half = relate._corr_gram(df, cols, list(combinations(cols, 2))).select("col_a", "col_b", F.col("r").alias("value"))
    other = half.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "value")
    own = spark.createDataFrame([(c, c, 1.0) for c in cols], half.schema)
    return tidy(half.unionByName(other).unionByName(own))


def _rank_sql(a, b, t):
    rk = lambda c: f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0"
    return f"select '{a}' as col_a, '{b}' as col_b, corr(ra, rb) as value from (select {rk(a)} as ra, {rk(b)} as rb from {t} where {a} is not null and {b} is not null) z"


_SP = ["qty", "price", "disc"]


@query("spearman_matrix", r(union_all([_rank_sql(a, b, W) for a in _SP for b in _SP if a != b] + [f"select '{c}', '{c}', 1.0::double" for c in _SP]), "value"))
def spearman_matrix(spark, sf):
    return tidy(relate.corr_matrix(_wide(spark, sf, *_SP), _SP, "spearman"))


def _tau_sql(a, b, t):
    return f"""select '{a}' as col_a, '{b}' as col_b, s / sqrt((p - ta) * (p - tb)) as r, n::bigint as n from
      (select sum(sign(x.{a} - y.{a}) * sign(x.{b} - y.{b})) as s from {t} x, {t} y where x.k < y.k) q,
      (select count(*) as n, count(*) * (count(*) - 1) / 2.0 as p from {t}) c,
      (select sum(m * (m - 1) / 2.0) as ta from (select count(*) as m from {t} group by {a})) u,
      (select sum(m * (m - 1) / 2.0) as tb from (select count(*) as m from {t} group by {b})) v"""


@query(
    "kendall_matrix",
    r("select col_a, col_b, r as value from (" + _tau_sql("a", "b", "(select c_custkey as k, c_nationkey as a, c_acctbal as b from customer)").replace("'a' as col_a", "'c_nationkey' as col_a").replace("'b' as col_b", "'c_acctbal' as col_b")
      + ") union all select 'c_acctbal', 'c_nationkey', r from (" + _tau_sql("a", "b", "(select c_custkey as k, c_nationkey as a, c_acctbal as b from customer)") + ") union all select 'c_nationkey', 'c_nationkey', 1 union all select 'c_acctbal', 'c_acctbal', 1", "value", 6),
)
def kendall_matrix(spark, sf):
    df = load(spark, sf, "customer")
    return tidy(relate.corr_matrix(df, ["c_nationkey", "c_acctbal"], "kendall"), 6)


_STRENGTH = "case when abs({x}) >= 0.8 then 'very strong' when abs({x}) >= 0.6 then 'strong' when abs({x}) >= 0.4 then 'moderate' when abs({x}) >= 0.2 then 'weak' else 'very weak' end"

# two-sided t tail by Simpson's rule on the density, 4000 intervals
_T_TAIL = """(select 1 - 2 * sum(case when i in (0, 4000) then 1 when i % 2 = 1 then 4 else 2 end
   * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi()) * pow(1 + pow(i * t / 4000.0, 2) / df, -(df + 1) / 2.0)) * t / 4000.0 / 3 as p
   from range(4001) g(i))"""


def _test_sql(a, b, t, spearman=False):
    base = _rank_sql(a, b, t) if spearman else corr_sql(a, b, t)
    return f"""select col_a, col_b, value as r, n, {_STRENGTH.format(x='value')} as strength, case when value > 0 then 'positive' else 'negative' end as direction,
      {_T_TAIL} as p_value from (select *, n - 2 as df, abs(value) * sqrt((n - 2) / (1 - value * value)) as t from ({base}) q,
      (select count(*) as n from {t} where {a} is not null and {b} is not null) c) w"""


_TEST_COLS = ["col_a", "col_b", "r", "n", "strength", "direction", "p_value"]


@query("pearson_test", r(union_all([_test_sql("qty", "price", W), _test_sql("disc", "tax", W)]), "r, p_value"))
def pearson_test(spark, sf):
    df = _wide(spark, sf, *WNUM)
    return tidy(relate.corr_test(df, [("qty", "price"), ("disc", "tax")], "pearson").select(*_TEST_COLS))


@query("spearman_test", r(_test_sql("o_custkey", "price", dsql("rough_orders"), True), "r, p_value"))
def spearman_test(spark, sf):
    df = derived(spark, sf, "rough_orders")
    return tidy(relate.corr_test(df, [("o_custkey", "price")], "spearman").select(*_TEST_COLS))


# F tail by Simpson's rule after x = d1 f / (d1 f + d2), I_x(d1/2, d2/2)
_F_TAIL = """(select case when d1 < 2 then null else 1 - sum(case when i in (0, 20000) then 1 when i % 2 = 1 then 4 else 2 end
   * case when i = 0 and d1 > 2 then 0 else exp(lgamma((d1 + d2) / 2.0) - lgamma(d1 / 2.0) - lgamma(d2 / 2.0)) * pow(i * x / 20000.0, d1 / 2.0 - 1) * pow(1 - i * x / 20000.0, d2 / 2.0 - 1) end) * x / 20000.0 / 3 end as p
   from range(20001) g(i))"""


def _anova_sql(num, cat, t):
    return f"""select '{num}' as num, '{cat}' as cat, f_stat, eta_squared, k as n_groups, n::bigint as n,
      case when eta_squared >= 0.14 then 'strong' when eta_squared >= 0.06 then 'moderate' when eta_squared >= 0.01 then 'weak' else 'very weak' end as strength,
      {_F_TAIL} as p_value from (
      select *, d1 * f_stat / (d1 * f_stat + d2) as x from (
      select count(*) as k, sum(m) as n, count(*) - 1 as d1, sum(m) - count(*) as d2,
        (sum(m * mean * mean) - sum(m * mean) * sum(m * mean) / sum(m)) / (count(*) - 1) / (sum(ss) / (sum(m) - count(*))) as f_stat,
        sum(m * pow(mean - g, 2)) / (sum(m * pow(mean - g, 2)) + sum(ss)) as eta_squared
      from (select count({num})::double as m, avg({num}) as mean, var_pop({num}) * count({num}) as ss from {t} where {cat} is not null and {num} is not null group by {cat}) a,
        (select avg({num}) as g from {t} where {cat} is not null and {num} is not null) b where m >= 2) s) w"""


@query("anova_test", r(union_all([_anova_sql("price", "prio", dsql("rough_orders")), _anova_sql("o_custkey", "prio", dsql("rough_orders"))]), "f_stat, eta_squared, p_value"))
def anova_test(spark, sf):
    df = derived(spark, sf, "rough_orders")
    out = relate.anova(df, [("price", "prio"), ("o_custkey", "prio")])
    return tidy(out.select("num", "cat", "f_stat", "eta_squared", "n_groups", "n", "strength", "p_value"))


@query("group_means", r("select 'o_totalprice' as num, 'o_orderpriority' as cat, o_orderpriority as value, count(*) as n, avg(o_totalprice) as mean from orders group by 3", "mean", 2))
def group_means(spark, sf):
    return tidy(relate.group_means(load(spark, sf, "orders"), "o_totalprice", "o_orderpriority"), 2)


@query("crosstab", f"select prio as val_a, flag as val_b, count(*) as n from {dsql('rough_orders')} where prio is not null group by 1, 2")
def crosstab(spark, sf):
    return relate.crosstab(derived(spark, sf, "rough_orders"), "prio", "flag")


def _cells(a, b, t):
    return f"""(select o, ra * rb / n as e, n, ka, kb from (select x.v as va, y.v as vb, coalesce(c.o, 0)::double as o, x.m::double as ra, y.m as rb,
      (select count(*) from {t} where {a} is not null and {b} is not null) as n, (select count(distinct {a}) from {t} where {b} is not null) as ka, (select count(distinct {b}) from {t} where {a} is not null) as kb
      from (select cast({a} as varchar) as v, count(*) as m from {t} where {a} is not null and {b} is not null group by 1) x
      cross join (select cast({b} as varchar) as v, count(*) as m from {t} where {a} is not null and {b} is not null group by 1) y
      left join (select cast({a} as varchar) as a, cast({b} as varchar) as b, count(*) as o from {t} group by 1, 2) c on c.a = x.v and c.b = y.v))"""


def _chi_sql(a, b, t, yates=True):
    gap = "case when ka = 2 and kb = 2 then greatest(abs(o - e) - 0.5, 0) else abs(o - e) end" if yates else "abs(o - e)"
    return f"""select '{a}' as col_a, '{b}' as col_b, chi2, dof, n::bigint as n, sqrt(chi2 / (n * k)) as cramers_v from (
      select sum(pow({gap}, 2) / e) as chi2, ((any_value(ka) - 1) * (any_value(kb) - 1))::bigint as dof, any_value(n) as n, least(any_value(ka), any_value(kb)) - 1 as k from {_cells(a, b, t)})"""


# chi-square tail for even dof in closed form
_CHI_TAIL = "case when dof % 2 = 0 then (select exp(-chi2 / 2) * sum(exp(i * ln(chi2 / 2) - lgamma(i + 1))) from range((dof // 2)::bigint) g(i)) end"


@query(
    "chi_square_test",
    r(f"select *, {_CHI_TAIL} as p_value from ({_chi_sql('o_orderstatus', 'o_orderpriority', 'orders')})", "chi2, cramers_v, p_value"),
)
def chi_square_test(spark, sf):
    out = relate.chi_square(load(spark, sf, "orders"), [("o_orderstatus", "o_orderpriority")])
    return tidy(out.select("col_a", "col_b", "chi2", "dof", "n", "cramers_v", "p_value"))


@query("chi_square_test_2x2", r(_chi_sql("quality", "toxic", "labels"), "chi2, cramers_v"))
def chi_square_test_2x2(spark, sf):
    out = relate.chi_square(load(spark, sf, "labels"), [("quality", "toxic")])
    return tidy(out.select("col_a", "col_b", "chi2", "dof", "n", "cramers_v"))


@query("cramers_v", r(f"select col_a, col_b, cramers_v from ({_chi_sql('p_brand', 'p_type', 'part', yates=False)})", "cramers_v"))
def cramers_v(spark, sf):
    return tidy(relate.cramers_v(load(spark, sf, "part"), "p_brand", "p_type"))


_PW = ["price", "o_custkey", "prio", "flag"]
_RO = dsql("rough_orders")


@query(
    "pairwise_tests",
    r(
        f"""select 'price' as col_a, 'o_custkey' as col_b, 'numeric-numeric' as pair_type, 'pearson' as test, value as statistic, abs(value) as effect, n from ({corr_sql('price', 'o_custkey', _RO)}), (select count(price) as n from {_RO})
        union all select num, cat, 'numeric-categorical', 'anova', f_stat, eta_squared, n from ({union_all([_anova_sql(a, b, _RO) for a in ('price', 'o_custkey') for b in ('prio', 'flag')])})
        union all select col_a, col_b, 'categorical-categorical', 'chi_square', chi2, cramers_v, n from ({_chi_sql('prio', 'flag', _RO)})""",
        "statistic, effect",
    ),
)
def pairwise_tests(spark, sf):
    df = derived(spark, sf, "rough_orders").select(*_PW)
    return tidy(relate.pairwise_tests(df).select("col_a", "col_b", "pair_type", "test", "statistic", "effect", "n"))


@query("pairwise_tests_worded")
def pairwise_tests_worded(spark, sf):
    """p values, strength and the sentence of every pair."""
    return relate.pairwise_tests(derived(spark, sf, "rough_orders").select(*_PW), interpret=True)


@query(
    "pairs_by_strength",
    f"""select col_a, col_b, pos from (select col_a, col_b, row_number() over (order by case when abs(value) >= 0.8 then 0 when abs(value) >= 0.6 then 1 when abs(value) >= 0.4 then 2 when abs(value) >= 0.2 then 3 else 4 end, col_a, col_b) as pos
       from ({union_all([corr_sql(a, b, W) for a, b in combinations(WNUM, 2)])}))""",
)
def pairs_by_strength(spark, sf):
    from pyspark.sql import Window

    from millrace.functions import labels

    pairs = relate.corr_pairs(_wide(spark, sf, *WNUM), WNUM)
    rank = labels.strength_rank(labels.band(F.abs("r"), labels.CORRELATION_BANDS))
    order = Window.orderBy(rank, "col_a", "col_b")  # one row per pair of columns
    return pairs.select("col_a", "col_b", F.row_number().over(order).cast("bigint").alias("pos"))


def _mi_sql(a, b, t, code):
    ca, cb = code(a), code(b)
    return f"""select '{a}' as col_a, '{b}' as col_b, sum(o / n * ln(o * n / (ra * rb))) as mi from (
      select count(*)::double as o, sum(count(*)) over (partition by va) as ra, sum(count(*)) over (partition by vb) as rb, sum(count(*)) over () as n
      from (select {ca} as va, {cb} as vb from {t}) z group by va, vb)"""


def _bin_code(stats_table):
    def code(c):
        if c in ("prio", "flag"):
            return f"coalesce(cast({c} as varchar), '__missing__')"
        x = f"coalesce({c}, (select median({c}) from {stats_table}))"
        lo, hi = f"(select min({c}) from {stats_table})", f"(select max({c}) from {stats_table})"
        return f"cast(least(greatest(ceil(({x} - {lo}) / (({hi} - {lo}) / 10.0::double)) - 1, 0), 9) as varchar)"
    return code


_MI = ["price", "o_custkey", "prio", "flag"]
_MI_SQL = union_all([_mi_sql(a, b, _RO, _bin_code(_RO)) for a in _MI for b in _MI if a != b] + [f"select '{c}', '{c}', 0.0::double" for c in _MI])


@query("mutual_info_matrix", r(_MI_SQL, "mi", 5))
def mutual_info_matrix(spark, sf):
    return tidy(relate.mutual_info_matrix(derived(spark, sf, "rough_orders"), _MI), 5)


@query("mi_heatmap", r(_MI_SQL, "mi", 5))
def mi_heatmap(spark, sf):
    return mutual_info_matrix(spark, sf)


def _target_sql(cols, target, t):
    return union_all([f"select '{c}' as feature, corr({c}, {target}) as r from {t}" for c in cols])


@query("target_correlation", r(_target_sql(["qty", "price_up", "disc", "tax"], "price", W), "r"))
def target_correlation(spark, sf):
    return tidy(relate.target_correlation(_wide(spark, sf, *WNUM), "price"))


_PAIRS = union_all([corr_sql(a, b, W) for a, b in combinations(WNUM, 2)])


@query("strong_pairs", r(f"select col_a, col_b, value as r, case when value >= 0 then 'positive' else 'negative' end as direction from ({_PAIRS}) where abs(value) >= 0.5", "r"))
def strong_pairs(spark, sf):
    return tidy(relate.strong_pairs(_wide(spark, sf, *WNUM)))


@query("multicollinear_pairs", r(f"select col_a, col_b, value as r from ({_PAIRS}) where abs(value) >= 0.85", "r"))
def multicollinear_pairs(spark, sf):
    return tidy(relate.multicollinear_pairs(_wide(spark, sf, *WNUM)))


@query("mean_abs_corr", r(f"select avg(abs(value)) as mean_abs_corr from ({_PAIRS})", "mean_abs_corr"))
def mean_abs_corr(spark, sf):
    return tidy(relate.mean_abs_corr(_wide(spark, sf, *WNUM)))


@query("top_numeric_pairs", r(f"select col_a, col_b, value as r from ({_PAIRS}) order by abs(value) desc, col_a, col_b limit 6", "r"))
def top_numeric_pairs(spark, sf):
    return tidy(relate.top_numeric_pairs(_wide(spark, sf, *WNUM), WNUM))


@query("ols_trendline", r(f"select 'qty' as x, 'price' as y, regr_slope(price, qty) as slope, regr_intercept(price, qty) as intercept, count(qty) as n from {W}", "slope, intercept", 3))
def ols_trendline(spark, sf):
    return tidy(relate.ols_trendline(_wide(spark, sf, "qty", "price"), "qty", "price"), 3)


def _jb(c, t):
    g1 = f"skewness({c}) * (count({c}) - 2) / sqrt(count({c})::double * (count({c}) - 1))"
    return f"""select '{c}' as "column", count({c}) as n, count({c}) / 6.0 * (pow({g1}, 2) + pow(kurtosis_pop({c}), 2) / 4) as statistic from {t}"""


@query("normality_test", r(f"select *, exp(-statistic / 2) as p_value, exp(-statistic / 2) > 0.05 as is_normal from ({_jb('value', 'events')} union all {_jb('event_id', 'events')})", "statistic, p_value", 2))
def normality_test(spark, sf):
    return tidy(relate.normality_test(load(spark, sf, "events"), ["value", "event_id"]), 2)


@query("normality_test_ks")
def normality_test_ks(spark, sf):
    return relate.ks_normality(load(spark, sf, "events"), "value")


@query("relationship_report", r(matrix_sql(["o_totalprice", "o_custkey"], "orders"), "value"))
def relationship_report(spark, sf):
    df = load(spark, sf, "orders").select("o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")
    return runs.relationship_report(spark, df)["pearson"]


@query("quick_analyze", "select 'c_custkey' as \"column\", 0::bigint as missing union all select 'c_name', 0 union all select 'c_nationkey', 0 union all select 'c_acctbal', count(*) - count(c_acctbal) from customer union all select 'c_mktsegment', 0")
def quick_analyze(spark, sf):
    return runs.quick_analyze(spark, load(spark, sf, "customer"))["missing"].select("column", "missing")


# ---- selection ----------------------------------------------------------------


def _kept(spark, df):
    return spark.createDataFrame([(c,) for c in df.columns], "feature string")


_SEL = ["qty", "price", "price_up", "disc", "konst", "tax"]
_VAR = union_all([f"select '{c}' as feature, var_samp({c}) as vs, var_pop(coalesce({c}, 0)) as vp from {W}" for c in _SEL])


@query("select_variance", f"select feature from ({_VAR}) where vs >= 0.01")
def select_variance(spark, sf):
    df = _wide(spark, sf, *_SEL)
    return _kept(spark, select.fit_variance(df).transform(df))


@query("select_variance_population", f"select feature from ({_VAR}) where vp > 0.01")
def select_variance_population(spark, sf):
    df = _wide(spark, sf, *_SEL)
    return _kept(spark, select.fit_variance(df, rule="population").transform(df))


@query(
    "select_corr_greedy",
    f"""select * from (values ('qty'), ('disc'), ('tax')) v(feature) union all
       select case when (select abs(corr(price, qty)) from {W}) >= (select abs(corr(price_up, qty)) from {W}) then 'price' else 'price_up' end from (select abs(corr(price, price_up)) as r from {W}) where r >= 0.9""",
)
def select_corr_greedy(spark, sf):
    df = _wide(spark, sf, *WNUM)
    return _kept(spark, select.fit_corr_greedy(df, "qty").transform(df))


@query("select_corr_upper", f"select unnest(['qty', 'price', 'price_up', 'disc', 'tax']) as feature except select col_b from ({_PAIRS}) where abs(value) > 0.9")
def select_corr_upper(spark, sf):
    df = _wide(spark, sf, *WNUM)
    return _kept(spark, select.fit_corr_upper(df).transform(df))


_TGT = _target_sql(["qty", "price_up", "disc", "tax"], "price", W)


@query("select_topk_target", f"select 'price' as feature union all (select feature from ({_TGT}) order by abs(r) desc, feature limit 2)")
def select_topk_target(spark, sf):
    df = _wide(spark, sf, *WNUM)
    return _kept(spark, select.fit_topk(df, "price", 2).transform(df))


@query("top_k_features", r(f"select feature, abs(r) as score from ({_TGT}) order by abs(r) desc, feature limit 3", "score"))
def top_k_features(spark, sf):
    return tidy(select.select_by_score(_wide(spark, sf, *WNUM), "price", top_k=3))


@query("select_by_score", r(f"select feature, abs(r) as score from ({_TGT}) where abs(r) >= 0.5", "score"))
def select_by_score(spark, sf):
    return tidy(select.select_by_score(_wide(spark, sf, *WNUM), "price", threshold=0.5))


@query(
    "select_by_score_mi",
    r(union_all([f"select '{c}' as feature, mi as score from ({_mi_sql(c, 'price', _RO, _bin_code(_RO))})" for c in ("o_custkey", "spiky")]), "score", 5),
)
def select_by_score_mi(spark, sf):
    df = derived(spark, sf, "rough_orders").select("o_custkey", "spiky", "price")
    return tidy(select.feature_scores(df, "price", "mutual_info"), 5)


@query(
    "select_cascade",
    r(
        f"""select feature as "column", 'low variance' as reason, vs as detail from ({_VAR}) where vs < 0.01 and feature <> 'qty'
        union all select case when (select abs(corr(price, qty)) from {W}) >= (select abs(corr(price_up, qty)) from {W}) then 'price_up' else 'price' end, 'correlated', r from (select abs(corr(price, price_up)) as r from {W}) where r >= 0.9""",
        "detail",
        6,
    ),
)
def select_cascade(spark, sf):
    _, why = select.cascade(_wide(spark, sf, *_SEL), "qty")
    return tidy(why, 6)


# ---- recommendations ----------------------------------------------------------


def _values(rows):
    return ", ".join("(" + ", ".join("null" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_RULE_ROWS = [(t, p, m, c, cap) for t, rules in recommend.RULES.items() for p, m, c, cap in rules]


@query(
    "recommend_models_rules",
    f"""select v.target_type, priority::int as priority, model, category from (values {_values(_RULE_ROWS)}) v(target_type, priority, model, category, cap),
       (select count(*) as n, case when count(distinct quality) <= 2 then 'binary' when count(distinct quality) <= 20 and count(*) / count(distinct quality) > 20 then 'multiclass' else 'continuous' end as t from labels) f
       where v.target_type = f.t and (cap is null or n < cap) order by priority limit 5""",
)
def recommend_models_rules(spark, sf):
    return recommend.recommend_by_rules(load(spark, sf, "labels"), "quality")


@query(
    "recommend_notes",
    f"""select note from (select count(*) as n, 4 as f, (select avg(abs(value)) from ({_PAIRS})) as c from lineitem), unnest([case when c > 0.7 then 'high multicollinearity' end,
       case when n < 500 then 'small dataset' end, case when n > 100000 then 'large dataset' end, case when n / f < 10 then 'few rows per feature' end]) u(note) where note is not null
       union all select 'check' as note""",
)
def recommend_notes(spark, sf):
    df = _wide(spark, sf, *WNUM)
    notes = recommend.preparation_notes(df, "price", relate.mean_abs_corr(df))
    return notes.unionByName(spark.createDataFrame([("check",)], "note string"))


_CAT_ROWS = [(f, i, *e[:3]) for f, es in recommend.CATALOGUE.items() for i, e in enumerate(es)]


@query(
    "recommend_models_scored",
    f"""select family, model, category, complexity, score from (select v.*, case when complexity = 'low' and n < 1000 then 1.0::double when complexity = 'medium' and n between 1000 and 99999 then 1.0
       when complexity = 'medium' and n >= 100000 then 0.8 when complexity = 'high' and n >= 10000 then 1.0 else 0.0 end + case when f < 20 and category in ('linear', 'neighbors') then 0.5 else 0.0 end as score
       from (values {_values(_CAT_ROWS)}) v(family, pos, model, category, complexity), (select count(*) as n, 4 as f, case when count(distinct price) = 2 then 'binary' when count(distinct price) <= 10 then 'multiclass' else 'continuous' end as t from {W}) q
       where v.family = t) order by score desc, pos limit 5""",
)
def recommend_models_scored(spark, sf):
    return recommend.recommend_by_score(_wide(spark, sf, *WNUM), "price")


@query("analyze_only", f"select 'overview' as section union all select unnest(['profile','distribution','outliers','correlation','strong_pairs','multicollinear','selection','recommendations','target_correlation']) where (select count(*) from {W}) > 0")
def analyze_only(spark, sf):
    """Sections with rows; lists that may be empty by nature count as present."""
    tables = runs.analyze_only(_wide(spark, sf, *WNUM), "price", PrepConfig())
    sizes = {n: t.limit(1).count() for n, t in tables.items()}
    assert all(v or n in ("strong_pairs", "multicollinear", "selection") for n, v in sizes.items()), sizes
    return spark.createDataFrame([(n,) for n in sizes], "section string")


