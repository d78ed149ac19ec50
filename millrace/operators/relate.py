"""Relationships between columns: correlations, ANOVA, contingency tests.

Work on raw rows is one aggregation per family of pairs; everything after it
runs on group rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import labels, pvalues
from millrace.functions import numeric as N
from millrace.functions.numeric import col, dbl
from millrace.operators import schema as S
from millrace.operators.features import base_stats, with_avg_rank
from millrace.operators.quantiles import exact_quantiles, value_freq
from millrace.operators.typing import column_routing_type

JVM_PAIRS = 36
MISSING = "__missing__"
PAIR_SCHEMA = (
    "col_a string, col_b string, pair_type string, test string, statistic double, p_value double, "
    "effect double, strength string, significant boolean, n bigint"
)


# ---- correlation --------------------------------------------------------------

def _corr_jvm(df: DataFrame, pairs) -> DataFrame:
    rows = []
    for a, b in pairs:
        x, y = dbl(a), dbl(b)
        rows.append(
            F.struct(
                F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                N.safe_corr(x, y).alias("r"), F.count(F.when(x.isNotNull(), y)).alias("n"),
            )
        )
    return df.agg(F.array(*rows).alias("p")).select(F.inline("p"))


def _corr_gram(df: DataFrame, cols: list[str], pairs) -> DataFrame:
    """Many columns: masked Gram matrices per task, summed by Spark.

    Values are shifted by the column means first so that the sums of squares
    do not cancel.
    """
    means = {c: s["mean"] or 0.0 for c, s in base_stats(df, cols).items()}
    shift = np.array([means[c] for c in cols])
    p = len(cols)
    upper = [(cols.index(a), cols.index(b)) for a, b in pairs]
    left = np.array([i for i, _ in upper])
    right = np.array([j for _, j in upper])

    def partial(batches):
        acc = np.zeros((6, p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64") - shift
            m = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x)
            sq = x * x
            acc += np.stack([m.T @ m, x.T @ m, m.T @ x, sq.T @ m, m.T @ sq, x.T @ x])
        out = acc[:, left, right]
        yield pd.DataFrame({"i": left, "j": right, **{f"s{k}": out[k] for k in range(6)}})

    schema = "i int, j int, " + ", ".join(f"s{k} double" for k in range(6))
    rows = df.select(*[dbl(c).alias(f"c{i}") for i, c in enumerate(cols)])
    sums = rows.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(f"s{k}").alias(f"s{k}") for k in range(6)]
    )
    n = F.col("s0")
    cov = F.col("s5") - F.try_divide(F.col("s1") * F.col("s2"), n)
    vx = F.col("s3") - F.try_divide(F.col("s1") * F.col("s1"), n)
    vy = F.col("s4") - F.try_divide(F.col("s2") * F.col("s2"), n)
    # a constant column leaves only rounding noise in its variance
    tiny = 1e-12
    flat = (vx <= tiny * F.col("s3")) | (vy <= tiny * F.col("s4"))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
        F.when(~flat, F.try_divide(cov, F.sqrt(vx * vy))).alias("r"), n.cast("bigint").alias("n"),
    )


def corr_pairs(df: DataFrame, cols: list[str], pairs=None) -> DataFrame:
    """(col_a, col_b, r, n) over complete rows of each pair; null r if undefined."""
    pairs = list(combinations(cols, 2)) if pairs is None else list(pairs)
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double, n bigint")
    if len(pairs) <= JVM_PAIRS:
        return _corr_jvm(df, pairs)
    return _corr_gram(df, sorted({c for p in pairs for c in p}, key=cols.index), pairs)


def _spearman_of_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rho over the complete rows of a pair, ranked inside them."""
    both = df.select(dbl(a).alias("a"), dbl(b).alias("b")).where("a is not null and b is not null")
    ranked = with_avg_rank(with_avg_rank(both, "a", "ra"), "b", "rb")
    return corr_pairs(ranked, ["ra", "rb"]).select(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), "r", "n")


def spearman_pairs(df: DataFrame, cols: list[str], pairs=None) -> DataFrame:
    """Pearson on average ranks.  Columns without nulls are ranked once; a pair
    with nulls is ranked within its complete rows."""
    pairs = list(combinations(cols, 2)) if pairs is None else list(pairs)
    row = df.agg(*[F.count_if(dbl(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).head()
    full = {c for i, c in enumerate(cols) if row[i] == 0}
    shared = [p for p in pairs if p[0] in full and p[1] in full]
    parts = []
    if shared:
        used = [c for c in cols if any(c in p for p in shared)]
        ranked = df.select(*[dbl(c).alias(c) for c in used])
        for c in used:
            ranked = with_avg_rank(ranked, c, f"{c}__rank")
        ranked = ranked.select(*[F.col(f"`{c}__rank`").alias(c) for c in used])
        parts.append(corr_pairs(ranked, used, shared))
    parts += [_spearman_of_pair(df, a, b) for a, b in pairs if (a, b) not in shared]
    return reduce(lambda x, y: x.unionByName(y), parts)


def corr_matrix(df: DataFrame, cols: list[str] | None = None, method: str = "pearson") -> DataFrame:
    """Long symmetric matrix with unit diagonal: (col_a, col_b, value)."""
    cols = cols or S.numeric_columns(df)
    if method == "kendall":
        from millrace.operators.kendall import kendall_pairs

        half = kendall_pairs(df, cols)
    else:
        half = {"pearson": corr_pairs, "spearman": spearman_pairs}[method](df, cols)
    half = half.select("col_a", "col_b", F.col("r").alias("value"))
    # both directions of a pair come from one row, so the aggregation runs once
    sides = F.array(
        F.struct("col_a", "col_b", "value"),
        F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), F.col("value")),
    )
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, value double")
    return half.select(F.inline(sides)).unionByName(diagonal)


def corr_test(df: DataFrame, pairs, method: str = "auto", skew_limit: float = 1.5) -> DataFrame:
    """One wide row per numeric pair: r of both kinds, the primary one, its p.

    auto: Spearman when |G1| of either side exceeds the limit.
    """
    pairs = list(pairs)
    cols = sorted({c for p in pairs for c in p})
    def facts(a, b):
        x, y = dbl(a), dbl(b)
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        n = F.count(xs)
        return F.struct(
            F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), n.alias("n"),
            N.safe_corr(x, y).alias("pearson_r"),
            F.abs(N.skew_sample(F.skewness(xs), n)).alias("skew_a"),
            F.abs(N.skew_sample(F.skewness(ys), n)).alias("skew_b"),
        )
    base = df.agg(F.array(*[facts(a, b) for a, b in pairs]).alias("p")).select(F.inline("p"))
    if method != "pearson":
        rho = spearman_pairs(df, cols, pairs).select("col_a", "col_b", F.col("r").alias("spearman_r"))
        # one row per pair on either side, merged by grouping
        both = base.unionByName(rho, allowMissingColumns=True).groupBy("col_a", "col_b")
        base = both.agg(*[F.max(c).alias(c) for c in ("n", "pearson_r", "skew_a", "skew_b", "spearman_r")])
    else:
        base = base.withColumn("spearman_r", F.lit(None).cast("double"))
    skewed = (F.col("skew_a") > skew_limit) | (F.col("skew_b") > skew_limit)
    use = {"auto": F.coalesce(skewed, F.lit(False)), "pearson": F.lit(False), "spearman": F.lit(True)}[method]
    r = F.when(use, F.col("spearman_r")).otherwise(F.col("pearson_r"))
    out = base.withColumn("r", r).withColumn("p_value", pvalues.corr_p(F.col("r"), F.col("n").cast("double")))
    return out.select(
        "col_a", "col_b", F.lit("numeric-numeric").alias("pair_type"),
        F.when(F.col("n") < 3, "insufficient_data").when(use, "spearman").otherwise("pearson").alias("test"),
        "r", "p_value", "pearson_r", "spearman_r",
        labels.band(F.abs("r"), labels.CORRELATION_BANDS).alias("strength"),
        labels.direction(F.col("r")).alias("direction"),
        F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("significant"), "n",
    )


# ---- numeric by category ------------------------------------------------------

def group_moments(df: DataFrame, pairs) -> DataFrame:
    """(num, cat, value, n, mean, ss) for every numeric-categorical pair.

    The category columns are unpivoted once and all numerics aggregated
    together, so the raw rows are shuffled (after map-side combine) once.
    """
    pairs = list(pairs)
    nums = sorted({a for a, _ in pairs})
    cats = sorted({b for _, b in pairs})
    rows = df.select(
        *[dbl(c).alias(f"__n{i}") for i, c in enumerate(nums)],
        F.inline(F.array(*[F.struct(F.lit(c).alias("cat"), col(c).cast("string").alias("value")) for c in cats])),
    ).where("value is not null")
    grouped = rows.groupBy("cat", "value").agg(
        *[
            F.struct(
                F.lit(c).alias("num"), F.count(f"__n{i}").alias("n"), F.avg(f"__n{i}").alias("mean"),
                (F.var_pop(f"__n{i}") * F.count(f"__n{i}")).alias("ss"),
            ).alias(f"g{i}")
            for i, c in enumerate(nums)
        ]
    )
    flat = grouped.select("cat", "value", F.inline(F.array(*[F.col(f"g{i}") for i in range(len(nums))])))
    keep = F.array(*[F.lit(f"{a}\x00{b}") for a, b in pairs])
    return flat.where(F.array_contains(keep, F.concat(F.col("num"), F.lit("\x00"), F.col("cat"))) & (F.col("n") > 0))


def anova(df: DataFrame, pairs) -> DataFrame:
    """One-way F, p and eta squared per (numeric, categorical) pair."""
    g = group_moments(df, pairs)
    n, mean, ss = F.col("n").cast("double"), F.col("mean"), F.col("ss")
    valid = F.col("n") >= 2
    # sums of n, n*mean, n*mean^2 around a per-pair origin keep the algebra stable
    origin = g.groupBy("num", "cat").agg(F.avg("mean").alias("o"))
    g = g.join(F.broadcast(origin), ["num", "cat"]).withColumn("d", F.col("mean") - F.col("o"))
    d = F.col("d")
    s = g.groupBy("num", "cat").agg(
        F.sum(n).alias("n_all"), F.sum(n * d).alias("sd_all"),
        F.count_if(valid).alias("k"), F.sum(F.when(valid, n)).alias("nv"),
        F.sum(F.when(valid, n * d)).alias("sdv"), F.sum(F.when(valid, n * d * d)).alias("sddv"),
        F.sum(F.when(valid, ss)).alias("ssw"),
    )
    grand = F.col("sd_all") / F.col("n_all")
    between_f = F.greatest(F.col("sddv") - F.col("sdv") * F.col("sdv") / F.col("nv"), F.lit(0.0))
    between_e = F.greatest(F.col("sddv") - 2 * grand * F.col("sdv") + grand * grand * F.col("nv"), F.lit(0.0))
    k, nv = F.col("k"), F.col("nv")
    enough = k >= 2
    f = F.when(enough, F.try_divide(between_f / F.nullif(k - 1, F.lit(0)), F.try_divide(F.col("ssw"), nv - k)))
    eta = F.when(enough, F.coalesce(F.try_divide(between_e, between_e + F.col("ssw")), F.lit(0.0)))
    out = s.select(
        F.col("num"), F.col("cat"), f.alias("f_stat"), eta.alias("eta_squared"), k.alias("n_groups"),
        nv.cast("bigint").alias("n"), (k - 1).cast("double").alias("d1"), (nv - k).cast("double").alias("d2"),
    )
    out = out.withColumn("p_value", pvalues.f_p(F.col("f_stat"), F.col("d1"), F.col("d2")))
    return out.select(
        "num", "cat", F.when(F.col("n_groups") >= 2, "anova").otherwise("insufficient_groups").alias("test"),
        "f_stat", "p_value", "eta_squared",
        labels.band(F.col("eta_squared"), labels.ETA_BANDS).alias("strength"),
        F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("significant"), "n_groups", "n",
    )


def group_means(df: DataFrame, num: str, cat: str) -> DataFrame:
    return group_moments(df, [(num, cat)]).select("num", "cat", "value", "n", "mean")


# ---- contingency --------------------------------------------------------------

def pair_cells(df: DataFrame, pairs, values: dict | None = None) -> DataFrame:
    """(col_a, col_b, val_a, val_b, n) for all pairs in one grouped pass."""
    values = values or {}
    get = lambda c: values.get(c, col(c).cast("string"))
    cells = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), get(a).alias("val_a"), get(b).alias("val_b"))
        for a, b in pairs
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .where("val_a is not null and val_b is not null")
        .groupBy("col_a", "col_b", "val_a", "val_b").agg(F.count(F.lit(1)).alias("n"))
    )


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return pair_cells(df, [(a, b)]).select("val_a", "val_b", "n")


def _with_margins(cells: DataFrame) -> DataFrame:
    """Cells with row, column and grand totals.  Plain equi-joins: AQE broadcasts
    a margin when it turns out small and splits a skewed one when it does not."""
    key = ["col_a", "col_b"]
    ra = cells.groupBy(*key, "val_a").agg(F.sum("n").alias("ra"))
    rb = cells.groupBy(*key, "val_b").agg(F.sum("n").alias("rb"))
    totals = ra.groupBy(*key).agg(F.sum("ra").alias("total"), F.count(F.lit(1)).alias("ka"))
    kb = rb.groupBy(*key).agg(F.count(F.lit(1)).alias("kb"))
    small = totals.join(kb, key)  # one row per pair of columns
    return cells.join(ra, [*key, "val_a"]).join(rb, [*key, "val_b"]).join(F.broadcast(small), key)


def chi_square(df: DataFrame, pairs, yates: bool = True, values: dict | None = None) -> DataFrame:
    """chi2, p, dof and Cramer's V per pair.

    sum((O-E)^2/E) = sum(O^2/E) - n, so empty cells need no rows.  For 2 x 2
    tables |O-E| is the same in all four cells, which gives the Yates form.
    """
    m = _with_margins(pair_cells(df, pairs, values))
    n = F.col("n").cast("double")
    expected = F.col("ra").cast("double") * F.col("rb") / F.col("total")
    s = m.groupBy("col_a", "col_b").agg(
        F.sum(n * n / expected).alias("q"), F.first("total").cast("double").alias("total"),
        F.first("ka").alias("ka"), F.first("kb").alias("kb"),
        F.max(F.abs(n - expected)).alias("gap"),
        # 1/E summed over all four cells of a 2 x 2 table
        F.max(F.col("ra") * (F.col("total") - F.col("ra"))).cast("double").alias("pa"),
        F.max(F.col("rb") * (F.col("total") - F.col("rb"))).cast("double").alias("pb"),
    )
    dof = (F.col("ka") - 1) * (F.col("kb") - 1)
    plain = F.greatest(F.col("q") - F.col("total"), F.lit(0.0))
    corrected = F.pow(F.greatest(F.col("gap") - 0.5, F.lit(0.0)), F.lit(2.0)) * F.try_divide(
        F.pow("total", F.lit(3.0)), F.col("pa") * F.col("pb")
    )
    chi2 = F.when(dof == 1, corrected).otherwise(plain) if yates else plain
    smaller = F.least("ka", "kb") - 1
    out = s.select(
        "col_a", "col_b", F.when(dof > 0, chi2).alias("chi2"), dof.cast("bigint").alias("dof"),
        F.col("total").cast("bigint").alias("n"), smaller.alias("__k"), F.col("ka").alias("n_a"), F.col("kb").alias("n_b"),
    )
    v = F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.col("__k")))
    out = out.withColumn("cramers_v", v).withColumn(
        "p_value", pvalues.chi2_p(F.col("chi2"), F.col("dof").cast("double"))
    )
    return out.select(
        "col_a", "col_b", F.when(F.col("dof") > 0, "chi_square").otherwise("insufficient_categories").alias("test"),
        "chi2", "p_value", "dof", "cramers_v",
        labels.band(F.col("cramers_v"), labels.CRAMERS_BANDS).alias("strength"),
        F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("significant"), "n", "n_a", "n_b",
    )


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Uncorrected V; 0 for a degenerate table."""
    out = chi_square(df, [(a, b)], yates=False)
    return out.select("col_a", "col_b", F.coalesce("cramers_v", F.lit(0.0)).alias("cramers_v"))


# ---- all pairs ----------------------------------------------------------------

def pairwise_tests(df: DataFrame, cols: list[str] | None = None, routes: dict[str, str] | None = None, interpret: bool = False) -> DataFrame:
    """Every column pair through the test its classes call for, strongest first."""
    cols = cols or df.columns
    if routes is None:
        part = df.select(*[col(c) for c in cols])
        routes = {r[0]: r[1] for r in column_routing_type(part).collect()}
    is_num = lambda c: routes[c] == "numeric"
    is_cat = lambda c: routes[c] in ("categorical", "high_cardinality")
    pairs = list(combinations(cols, 2))
    nn = [p for p in pairs if is_num(p[0]) and is_num(p[1])]
    nc = [p if is_num(p[0]) else (p[1], p[0]) for p in pairs if (is_num(p[0]) and is_cat(p[1])) or (is_cat(p[0]) and is_num(p[1]))]
    cc = [p for p in pairs if is_cat(p[0]) and is_cat(p[1])]
    parts = []
    if nn:
        parts.append(
            corr_test(df, nn).select(
                "col_a", "col_b", "pair_type", "test", F.col("r").alias("statistic"), "p_value",
                F.abs("r").alias("effect"), "strength", "significant", "n",
            )
        )
    if nc:
        flipped = F.array(*[F.lit(f"{b}\x00{a}") for a, b in nc if cols.index(b) < cols.index(a)] or [F.lit("")])
        swap = F.array_contains(flipped, F.concat("cat", F.lit("\x00"), "num"))
        parts.append(
            anova(df, nc).select(
                F.when(swap, F.col("cat")).otherwise(F.col("num")).alias("col_a"),
                F.when(swap, F.col("num")).otherwise(F.col("cat")).alias("col_b"),
                F.lit("numeric-categorical").alias("pair_type"), "test", F.col("f_stat").alias("statistic"),
                "p_value", F.col("eta_squared").alias("effect"), "strength", "significant", "n",
            )
        )
    if cc:
        parts.append(
            chi_square(df, cc).select(
                "col_a", "col_b", F.lit("categorical-categorical").alias("pair_type"), "test",
                F.col("chi2").alias("statistic"), "p_value", F.col("cramers_v").alias("effect"),
                "strength", "significant", "n",
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    if interpret:
        out = out.withColumn(
            "interpretation",
            labels.interpretation(F.col("test"), F.col("strength"), F.col("effect"), F.col("p_value")),
        )
    return out.orderBy(labels.strength_rank(F.col("strength")), "col_a", "col_b")


def filter_pairs(pairs: DataFrame, pair_type: str | None = None, significant_only: bool = False) -> DataFrame:
    if pair_type:
        pairs = pairs.where(F.col("pair_type") == pair_type)
    return pairs.where("significant") if significant_only else pairs


# ---- mutual information -------------------------------------------------------

def binned_values(df: DataFrame, cols: list[str], bins: int = 10, cuts: str = "width") -> dict:
    """A discrete text code per column: categories as they are, numbers binned
    (equal width or quantile cuts), nulls as median or the missing token."""
    numbers = [c for c in cols if c in S.numeric_columns(df)]
    out = {c: F.coalesce(col(c).cast("string"), F.lit(MISSING)) for c in cols if c not in numbers}
    probs = [i / bins for i in range(1, bins)] if cuts == "quantile" else []
    q = exact_quantiles(df, numbers, [0.5, *probs])
    stats = base_stats(df, numbers) if cuts == "width" else {}
    for c in numbers:
        x = F.coalesce(dbl(c), F.lit(q[c][0]))
        if cuts == "width":
            out[c] = N.equal_width_bin(x, stats[c]["min"], stats[c]["max"], bins).cast("string")
        else:
            above = [(x > F.lit(b)).cast("int") for b in sorted({b for b in q[c][1:] if b is not None})]
            out[c] = reduce(lambda a, b: a + b, above, F.lit(0)).cast("string")
    return out


def mutual_info(df: DataFrame, cols: list[str], bins: int = 10, cuts: str = "width", pairs=None) -> DataFrame:
    """Plug-in mutual information (nats) of each pair from binned counts."""
    pairs = list(combinations(cols, 2)) if pairs is None else list(pairs)
    m = _with_margins(pair_cells(df, pairs, binned_values(df, cols, bins, cuts)))
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    term = n / total * F.log(n * total / (F.col("ra").cast("double") * F.col("rb")))
    return m.groupBy("col_a", "col_b").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mi"))


def mutual_info_matrix(df: DataFrame, cols: list[str], bins: int = 10, cuts: str = "width") -> DataFrame:
    """Both directions of each pair; a column with itself is 0."""
    half = mutual_info(df, cols, bins, cuts)
    sides = F.array(
        F.struct("col_a", "col_b", "mi"),
        F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), F.col("mi")),
    )
    own = df.sparkSession.createDataFrame([(c, c, 0.0) for c in cols], "col_a string, col_b string, mi double")
    return half.select(F.inline(sides)).unionByName(own)


# ---- lists over the matrix ----------------------------------------------------

def target_correlation(df: DataFrame, target: str, cols: list[str] | None = None, absolute: bool = False) -> DataFrame:
    cols = [c for c in (cols or S.numeric_columns(df)) if c != target]
    r = corr_pairs(df, [*cols, target], [(c, target) for c in cols])
    out = r.select(F.col("col_a").alias("feature"), (F.abs("r") if absolute else F.col("r")).alias("r"))
    return out.orderBy(F.desc_nulls_last(F.abs("r")), "feature")


def strong_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.5, target: str | None = None) -> DataFrame:
    cols = cols or S.numeric_columns(df)
    pairs = [(c, target) for c in cols if c != target] if target else None
    out = corr_pairs(df, cols if not target or target in cols else [*cols, target], pairs).where(F.abs("r") >= threshold)
    sign = F.when(F.col("r") >= 0, "positive").otherwise("negative")
    return out.select("col_a", "col_b", "r", sign.alias("direction")).orderBy(F.desc(F.abs("r")), "col_a", "col_b")


def multicollinear_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.85) -> DataFrame:
    return strong_pairs(df, cols, threshold).select("col_a", "col_b", "r")


def mean_abs_corr(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return corr_pairs(df, cols or S.numeric_columns(df)).agg(
        F.coalesce(F.avg(F.abs("r")), F.lit(0.0)).alias("mean_abs_corr")
    )


def top_numeric_pairs(df: DataFrame, cols: list[str], k: int = 6) -> DataFrame:
    return (
        corr_pairs(df, cols).where("r is not null").select("col_a", "col_b", "r")
        .orderBy(F.desc(F.abs("r")), "col_a", "col_b").limit(k)
    )


def ols_trendline(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of y on x over complete rows."""
    a, b = dbl(x), dbl(y)
    both = a.isNotNull() & b.isNotNull()
    slope = N.safe_slope(a, b)
    base = df.agg(
        slope.alias("slope"), F.avg(F.when(both, a)).alias("mx"), F.avg(F.when(both, b)).alias("my"),
        F.count_if(both).alias("n"),
    )
    return base.select(
        F.lit(x).alias("x"), F.lit(y).alias("y"), "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"), "n"
    )


def normality_test(df: DataFrame, cols: list[str], alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera on all rows: n/6 (g1^2 + g2^2/4); chi-square tail with 2 df."""
    def facts(c):
        x = dbl(c)
        return F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))
    m = df.agg(F.array(*[facts(c) for c in cols]).alias("m")).select(F.inline("m"))
    jb = F.col("n") / 6.0 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4)
    enough = F.col("n") >= 8
    out = m.select("column", "n", F.when(enough, jb).alias("statistic"))
    p = F.exp(-F.col("statistic") / 2)
    return out.withColumn("p_value", p).withColumn("is_normal", F.col("p_value") > alpha)


def ks_normality(df: DataFrame, c: str) -> DataFrame:
    """Kolmogorov-Smirnov distance from the fitted normal."""
    from pyspark.ml.stat import KolmogorovSmirnovTest

    s = base_stats(df, [c])[c]
    rows = df.select(dbl(c).alias("x")).where("x is not null")
    out = KolmogorovSmirnovTest.test(rows, "x", "norm", s["mean"], s["sd"])
    return out.select(F.lit(c).alias("column"), F.col("pValue").alias("p_value"), "statistic")


def value_entropy(df: DataFrame, cols: list[str]) -> DataFrame:
    """Base-2 entropy of several columns at once."""
    k = F.col("count").cast("double")
    return value_freq(df, cols).groupBy("column").agg(
        ((F.log(F.sum(k)) - F.sum(k * F.log(k)) / F.sum(k)) / F.log(F.lit(2.0))).alias("entropy")
    )
