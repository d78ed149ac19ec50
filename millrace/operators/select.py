"""Feature selection.  Spark computes the scores; the scan over the (columns x
columns) matrix is a small driver-side rule."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import dbl
from millrace.operators import schema as S
from millrace.operators.relate import corr_pairs, mutual_info, target_correlation
from millrace.plans.fitted import Step

REASONS = "`column` string, reason string, detail double"


def _numeric_features(df, target, keep=()):
    return [c for c in S.numeric_columns(df) if c != target and c not in keep]


def variances(df: DataFrame, cols: list[str], null_as_zero: bool = False) -> dict[str, float | None]:
    agg = F.var_pop if null_as_zero else F.var_samp
    x = (lambda c: F.coalesce(dbl(c), F.lit(0.0))) if null_as_zero else dbl
    row = df.agg(*[agg(x(c)).alias(f"v{i}") for i, c in enumerate(cols)]).head() if cols else []
    return {c: row[i] for i, c in enumerate(cols)}


def low_variance(df: DataFrame, target=None, threshold: float = 0.01, rule: str = "sample", keep=()) -> list[str]:
    """rule sample: ddof-1 variance below the threshold; population: variance of
    null-as-0 at most the threshold, and nothing is dropped if all would go."""
    cols = _numeric_features(df, target, keep)
    v = variances(df, cols, rule == "population")
    if rule == "population":
        bad = [c for c in cols if v[c] is not None and v[c] <= threshold]
        return [] if len(bad) == len(cols) else bad
    return [c for c in cols if v[c] is not None and v[c] < threshold]


def _matrix(df, cols):
    return {(r["col_a"], r["col_b"]): abs(r["r"]) for r in corr_pairs(df, cols).collect() if r["r"] is not None}


def greedy_drop(cols: list[str], r: dict, score: dict, threshold: float) -> list[tuple[str, str, float]]:
    """Walk the pairs in column order; of a pair at or above the threshold the
    one less related to the target goes (the later one on ties).
    Returns (loser, winner, |r|)."""
    gone: dict[str, tuple[str, float]] = {}
    for pair in combinations(cols, 2):
        strength = r.get(pair, 0.0)
        if strength < threshold or gone.keys() & set(pair):
            continue
        winner, loser = sorted(pair, key=lambda c: (-score.get(c, 0.0), cols.index(c)))
        gone[loser] = (winner, strength)
    return [(loser, winner, strength) for loser, (winner, strength) in gone.items()]


def correlated_greedy(df: DataFrame, target=None, threshold: float = 0.90, keep=()) -> list[tuple[str, str, float]]:
    cols = _numeric_features(df, target, keep)
    score = {}
    if target:
        score = {r["feature"]: abs(r["r"] or 0.0) for r in target_correlation(df, target, cols).collect()}
    return greedy_drop(cols, _matrix(df, cols), score, threshold)


def correlated_upper(df: DataFrame, target=None, threshold: float = 0.90) -> list[str]:
    """Columns with |r| above the threshold to any earlier column."""
    hits = corr_pairs(df, _numeric_features(df, target)).where(F.abs("r") > threshold)
    return sorted(r[0] for r in hits.select("col_b").distinct().collect())


def top_k_by_target(df: DataFrame, target: str, k: int, keep=()) -> list[str]:
    cols = _numeric_features(df, target, keep)
    rows = target_correlation(df, target, cols).limit(k).collect()
    return [r["feature"] for r in rows]


def _step(columns, reason):
    return Step("drop", {"columns": columns, "reason": reason})


def fit_variance(df, target=None, threshold=0.01, rule="sample", keep=()) -> Step:
    return _step(low_variance(df, target, threshold, rule, keep), "low variance")


def fit_corr_greedy(df, target=None, threshold=0.90, keep=()) -> Step:
    return _step([x[0] for x in correlated_greedy(df, target, threshold, keep)], "correlated")


def fit_corr_upper(df, target=None, threshold=0.90) -> Step:
    return _step(correlated_upper(df, target, threshold), "correlated")


def fit_topk(df, target, k, keep=()) -> Step:
    best = set(top_k_by_target(df, target, k, keep))
    return _step([c for c in _numeric_features(df, target, keep) if c not in best], "below top k")


def cascade(df: DataFrame, target: str | None = None, variance: float = 0.01, corr: float = 0.90, top_k: int = 0, keep=()) -> tuple[Step, DataFrame]:
    """Variance, then correlation, then top k.  Returns the drop step and the
    (column, reason, detail) table."""
    rows = []
    dropped: list[str] = []
    cols = _numeric_features(df, target, keep)
    v = variances(df, cols)
    for c in cols:
        if v[c] is not None and v[c] < variance:
            rows.append((c, "low variance", float(v[c])))
            dropped.append(c)
    rest = S.drop_columns(df, dropped)
    for loser, _, r in correlated_greedy(rest, target, corr, keep):
        rows.append((loser, "correlated", float(r)))
        dropped.append(loser)
    if top_k > 0 and target:
        rest = S.drop_columns(df, dropped)
        ranked = target_correlation(rest, target, _numeric_features(rest, target, keep)).collect()
        for r in ranked[top_k:]:
            rows.append((r["feature"], "below top k", abs(r["r"] or 0.0)))
            dropped.append(r["feature"])
    return _step(dropped, "cascade"), df.sparkSession.createDataFrame(rows, REASONS)


def feature_scores(df: DataFrame, target: str, method: str = "correlation", bins: int = 10) -> DataFrame:
    """(feature, score) by variance, correlation, mutual_info or random_forest."""
    cols = _numeric_features(df, target)
    if method in ("correlation", "auto"):
        return target_correlation(df, target, cols).select("feature", F.coalesce(F.abs("r"), F.lit(0.0)).alias("score"))
    if method == "variance":
        v = variances(df, cols)
        return df.sparkSession.createDataFrame([(c, v[c]) for c in cols], "feature string, score double")
    if method == "mutual_info":
        mi = mutual_info(df, [*cols, target], bins, pairs=[(c, target) for c in cols])
        return mi.select(F.col("col_a").alias("feature"), F.col("mi").alias("score"))
    if method == "random_forest":
        from millrace.operators.ml import forest_importance

        return forest_importance(df, target, cols).select("feature", F.col("importance").alias("score"))
    raise ValueError(f"unknown scoring method {method!r}")


def select_by_score(df: DataFrame, target: str, method: str = "correlation", threshold: float = 0.0, top_k: int = 0, fallback: int = 5) -> DataFrame:
    """Features kept: the top k, or those at the threshold, or the best five."""
    scores = feature_scores(df, target, method)
    best = scores.orderBy(F.desc("score"), "feature")
    if top_k > 0:
        return best.limit(top_k)
    passed = scores.where(F.col("score") >= threshold)
    return passed if passed.limit(1).count() else best.limit(fallback)
