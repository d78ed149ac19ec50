"""Chaining the operators: preprocess, analyse, build models, report."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numeric import col
from millrace.operators import chartdata, clean, encode, features, impute, ml, outliers, recommend, relate, select, split, stats
from millrace.operators import schema as S
from millrace.operators import typing as ty
from millrace.plans.config import PrepConfig
from millrace.plans.fitted import FittedPlan, Step, applies
from millrace.session import ensure_checkpoint_dir
from millrace.sources.readers import read_any

log = logging.getLogger("millrace")
SUMMARY = "stage string, item string, value string"


@applies("rename")
def _apply_rename(df, p):
    return S.rename(df, p["style"])


@applies("text")
def _apply_text(df, p):
    df = clean.lowercase_text(df) if p["lower"] else clean.trim_text(df) if p["trim"] else df
    return clean.null_tokens(df) if p["null_tokens"] else df


@applies("residual_zero")
def _apply_residual_zero(df, p):
    return clean.fill_residual_zero(df)


@dataclass
class Prepared:
    df: DataFrame
    plan: FittedPlan
    summary: list[tuple[str, str, str]] = field(default_factory=list)

    def summary_table(self) -> DataFrame:
        return self.df.sparkSession.createDataFrame(self.summary, SUMMARY)


class _Run:
    """State of one preprocessing run: current frame, fitted steps, notes."""

    def __init__(self, df: DataFrame, cfg: PrepConfig):
        self.df, self.cfg = S.canonical(df), cfg
        self.plan = FittedPlan()
        self.notes: list[tuple[str, str, str]] = []
        self.protected = [c for c in [cfg.target, *cfg.keys] if c]

    def use(self, step: Step, stage: str, item: str | None = None, value=None):
        self.plan.add(step)
        self.df = step.transform(self.df)
        if item:
            self.notes.append((stage, item, str(value)))

    def features(self) -> list[str]:
        return [c for c in self.df.columns if c not in self.protected]


def _cleaning(r: _Run):
    cfg = r.cfg
    r.use(Step("rename", {"style": cfg.name_style}), "cleaning")
    r.use(Step("drop", {"columns": cfg.drop_columns}), "cleaning", "user_dropped", len(cfg.drop_columns))
    r.use(Step("text", {"lower": cfg.lowercase_text, "trim": cfg.trim_text, "null_tokens": cfg.null_tokens}), "cleaning")
    # counted, not observed: a session with an Observation cannot serialize models that hold a summary
    n0 = r.df.count()
    if cfg.target:
        r.df = r.df.where(col(cfg.target).isNotNull())
    if cfg.drop_duplicates:
        r.df = r.df.dropDuplicates()
    # every later fit reads this table, so the shuffle above runs once
    ensure_checkpoint_dir(r.df.sparkSession)
    r.df = r.df.checkpoint()
    n1 = r.df.count()
    r.notes += [("cleaning", "rows_before", str(n0)), ("cleaning", "rows_after", str(n1)), ("cleaning", "rows_removed", str(n0 - n1))]
    for name, step in (
        ("high_null", clean.fit_drop_high_null(r.df, cfg.null_threshold, r.protected)),
        ("constant", clean.fit_drop_constant(r.df, r.protected) if cfg.drop_constant else None),
        ("id", clean.fit_drop_ids(r.df, r.protected, whole_tokens=True) if cfg.drop_ids else None),
    ):
        if step is not None:
            r.use(step, "cleaning", f"dropped_{name}", sorted(step.params["columns"]))


def _types(r: _Run):
    cfg = r.cfg
    if cfg.cast_types:
        r.use(Step("cast_forced", {"types": cfg.cast_types}), "type", "forced", sorted(cfg.cast_types))
    texts = [c for c in S.text_columns(r.df) if c not in r.protected]
    if texts:
        facts = {f["column"]: f for f in ty.text_facts(r.df, texts).collect()}
        flags = [c for c in texts if facts[c]["is_bool_like"] and facts[c]["n"]]
        numbers = [c for c in texts if c not in flags and (facts[c]["number_ratio"] or 0) >= cfg.coerce_ratio]
        dates = [c for c in texts if c not in flags + numbers and facts[c]["date_ratio"] >= 0.8]
        r.use(Step("bool_int", {"columns": flags}), "type", "boolean", sorted(flags))
        r.use(Step("coerce_numeric", {"columns": numbers}), "type", "numeric", sorted(numbers))
    else:
        dates = []
    dates += [c for c in S.time_columns(r.df) if c not in r.protected]
    if dates:
        r.use(
            Step("datetime_parts", {"columns": dates, "with_time": cfg.datetime_with_time}),
            "type", "datetime", sorted(dates),
        )


def _missing(r: _Run):
    choice = {c: s for c, s in r.cfg.impute_columns.items() if s != "auto"}
    gaps = [c for c, share in clean.null_ratios(r.df).items() if share > 0]
    # columns without a gap are fitted too: rows seen later may have one
    step = impute.fit_impute_auto(r.df, r.cfg.impute_rule, choice, skip=r.protected)
    r.use(step, "missing", "filled", len([c for c in gaps if c in step.params["values"]]))


def _encoding(r: _Run):
    choice = {c: s for c, s in r.cfg.encode_columns.items() if s != "auto"}
    steps = encode.fit_encode_auto(r.df, choice, skip=r.protected, target=r.cfg.target)
    for step in steps:
        r.use(step, "encoding")
    sweep = encode.fit_residual_sweep(r.df, skip=r.protected)
    for step in sweep:
        r.use(step, "encoding")
    r.notes.append(("encoding", "encoded", str(len(steps) + len(sweep))))


def _feature(r: _Run):
    cfg = r.cfg
    if cfg.feature_rules:
        r.use(features.fit_rules(r.df, cfg.feature_rules), "feature", "rules", len(cfg.feature_rules))
    numbers = [c for c in S.numeric_columns(r.df) if c not in r.protected]
    if cfg.log_skewed:
        r.use(features.fit_log_skewed(r.df, numbers), "feature")
    if cfg.row_stats and len(numbers) >= 2:
        r.use(Step("row_stats", {"columns": numbers}), "feature", "row_stats", 4)
    if cfg.interactions and len(numbers) >= 2:
        r.use(Step("interactions", {"columns": numbers}), "feature", "interactions", len(numbers))
    if cfg.scaling:
        r.use(features.fit_scale(r.df, numbers, cfg.scaling), "feature", "scaled", cfg.scaling)


@applies("row_stats")
def _apply_row_stats(df, p):
    return features.row_stats(df, [c for c in p["columns"] if c in df.columns])


@applies("interactions")
def _apply_interactions(df, p):
    return features.interactions(df, [c for c in p["columns"] if c in df.columns])


def _validation(r: _Run):
    doubles = [c for c in S.numeric_columns(r.df) if c not in r.protected]
    r.use(clean.fit_replace_inf(r.df, "zero", [c for c in doubles if r.df.schema[c].dataType.simpleString() in ("double", "float")]), "validation")
    r.use(Step("residual_zero", {}), "validation")
    gate = clean.validation_gate(S.drop_columns(r.df, r.protected))
    bad = gate.where("level = 'error'").count()
    r.notes.append(("validation", "errors", str(bad)))


_STAGE_FN = {
    "cleaning": _cleaning, "type": _types, "missing": _missing,
    "encoding": _encoding, "feature": _feature, "validation": _validation,
}


def preprocess_only(df: DataFrame, config: PrepConfig | None = None, extra_stages: dict | None = None) -> Prepared:
    """Run the active stages.  ``extra_stages`` maps a name to a user function
    DataFrame -> DataFrame that runs after the built-in ones."""
    cfg = config or PrepConfig()
    problems = cfg.problems()
    if problems:
        raise ValueError("; ".join(problems))
    r = _Run(df, cfg)
    r.notes.append(("input", "columns", str(len(df.columns))))
    for stage in [s for s in _STAGE_FN if s in cfg.stages]:
        started = time.time()
        try:
            _STAGE_FN[stage](r)
        except Exception as e:
            if not cfg.safe_mode:
                raise
            log.exception("stage %s failed", stage)
            r.notes.append((stage, "failed", str(e)[:200]))
        log.info("stage %s took %.2f s", stage, time.time() - started)
    for name, fn in (extra_stages or {}).items():
        r.df = fn(r.df)
        r.notes.append((name, "user_stage", "done"))
    r.notes.append(("output", "columns", str(len(r.df.columns))))
    return Prepared(r.df, r.plan, r.notes)


def analyze_only(df: DataFrame, target: str | None, config: PrepConfig | None = None) -> dict[str, DataFrame]:
    """Profile, outliers, selection, relationships, recommendations."""
    return _analysis(df, target, config or PrepConfig())[0]


def _analysis(df: DataFrame, target: str | None, cfg: PrepConfig) -> tuple[dict[str, DataFrame], list[Step]]:
    """The tables, and the steps fitted for them: outliers and, with a target, selection."""
    skip = [c for c in [target, *cfg.keys] if c]
    numbers = [c for c in S.numeric_columns(df) if c not in cfg.keys]
    fences = outliers.fit_outliers(
        df, numbers, cfg.outlier_method, cfg.outlier_strategy, skip=skip
    )
    out = {
        "overview": stats.overview(df),
        "profile": stats.full_profile(df, numbers),
        "distribution": stats.distribution_breakdown(df, numbers),
        "outliers": outliers.outlier_report(df, fences).orderBy(F.desc("pct"), "column"),
        "correlation": relate.corr_matrix(df, numbers),
        "strong_pairs": relate.strong_pairs(df, numbers),
        "multicollinear": relate.multicollinear_pairs(df, numbers),
    }
    steps = [fences]
    if target:
        features_only = S.drop_columns(df, cfg.keys)
        chosen, out["selection"] = select.cascade(features_only, target, cfg.variance_threshold, cfg.corr_threshold, cfg.top_k)
        steps.append(chosen)
        out["recommendations"] = recommend.recommend_by_rules(features_only, target)
        if target in numbers:
            out["target_correlation"] = relate.target_correlation(df, target, numbers)
    return out, steps


def build_models_only(df: DataFrame, config: PrepConfig, split: str | None = None) -> ml.AutoResult:
    """Train and rank the models, on the parts named by column ``split`` if it is given."""
    cfg = config
    names = [c for c in S.numeric_columns(df) if c not in [cfg.target, *cfg.keys, "split"]]
    return ml.automl_run(
        df, cfg.target, cfg.keys, names, cfg.models, cfg.max_models, cfg.time_limit, cfg.cv_folds, cfg.test_size,
        split=split,
    )


@dataclass
class FullRun:
    prepared: Prepared
    tables: dict[str, DataFrame]
    data: DataFrame
    models: ml.AutoResult | None = None


def full_run(spark: SparkSession, source, config: PrepConfig, with_models: bool = True) -> FullRun:
    """Load, preprocess, treat outliers, select, split, analyse, build models."""
    df = read_any(spark, source)
    prepared = preprocess_only(df, config)
    # the prepared table is read by every analysis and model below
    ensure_checkpoint_dir(spark)
    prepared.df = prepared.df.checkpoint()
    target, keys = config.target, config.keys
    tables, steps = _analysis(prepared.df, target, config)
    data = prepared.df
    if target:
        for step in steps:  # fitted once, for the tables and the plan
            prepared.plan.add(step)
            data = step.transform(data)
        if keys:
            by = target if split.should_stratify(data, target) else None
            data = split.fit_split(data, keys, config.test_size, config.val_size, by).transform(data)
    models = build_models_only(data, config, "split") if with_models and target and keys else None
    if models:
        tables["leaderboard"] = models.leaderboard
    tables["summary"] = prepared.summary_table()
    return FullRun(prepared, tables, data, models)


def quick_analyze(spark: SparkSession, source) -> dict[str, DataFrame]:
    df = read_any(spark, source)
    return {"overview": stats.overview(df), "missing": stats.missing_report(df), "columns": ty.detect_column_type(df)}


def relationship_report(spark: SparkSession, source, columns: list[str] | None = None, sample: int | None = None, keys: list[str] | None = None) -> dict[str, DataFrame]:
    """Tables of the relationship analysis: one read, then batched aggregates."""
    df = clean.null_tokens(clean.trim_text(S.canonical(read_any(spark, source))))
    df = clean.drop_empty_rows_cols(df)
    df = ty.fit_coerce_numeric(df, 0.70, strict=True).transform(df)
    if sample:
        if not keys:
            raise ValueError("a sample needs the key columns that choose its rows")
        df = split.sample_n(df, keys, sample)
    df = S.select_columns(df, columns or df.columns)
    return report_tables(df)


def report_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All sections of the report as named tables."""
    numbers, words = S.numeric_columns(df), S.text_columns(df)
    out = {
        "overview": stats.overview(df),
        "health": stats.health_scores(df),
        "missing": stats.missing_report(df),
        "pairs": relate.pairwise_tests(df, interpret=True),
    }
    if numbers:
        out["numeric"] = stats.describe_numeric(df, numbers)
        out["histogram"] = chartdata.histogram(df, numbers)
        fences = outliers.fit_outliers(df, numbers, "iqr", "none", min_values=1)
        out["outliers"] = outliers.outlier_report(df, fences).orderBy(F.desc("pct"), "column")
    if len(numbers) >= 2:
        out["pearson"] = relate.corr_matrix(df, numbers).withColumn("value", F.round("value", 4))
        out["spearman"] = relate.corr_matrix(df, numbers, "spearman").withColumn("value", F.round("value", 4))
    if words:
        out["categorical"] = stats.describe_categorical(df, words)
        out["top_values"] = stats.top_values(df, words)
    return out

