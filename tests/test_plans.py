"""Physical plans: what reaches the scan, what is shuffled, how many jobs run."""

import uuid

from pyspark.sql import functions as F

from millrace.catalog.base import load
from millrace.operators import features, impute, outliers, split, stats
from millrace.plans import run
from millrace.plans.config import PrepConfig


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark, fn):
    tag = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(tag, tag)
    try:
        fn()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_columns_are_pruned(spark, sf):
    p = plan(stats.moments(load(spark, sf, "lineitem"), ["l_quantity"]))
    assert "ReadSchema: struct<l_quantity:double>" in p


def test_filter_reaches_the_scan(spark, sf):
    p = plan(load(spark, sf, "lineitem").where("l_discount > 0.05").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in p


def test_fitted_transform_has_no_shuffle(spark, sf):
    df = load(spark, sf, "orders")
    out = outliers.fit_outliers(df, ["o_totalprice"], "iqr", "clip").transform(df)
    out = features.fit_scale(df, ["o_totalprice"], "standard").transform(out)
    out = split.fit_split(df, ["o_orderkey"], 0.2, 0.1).transform(out)
    assert "Exchange" not in plan(out) and "Python" not in plan(out)


def test_top_values_limits_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(stats.top_values(load(spark, sf, "part"), ["p_brand", "p_type"], 5))


def test_no_unpartitioned_window_over_rows(spark, sf):
    df = load(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    filled = plan(impute.ffill(df, ["v"], ["ts", "event_id"])).splitlines()
    assert any("Exchange hashpartitioning(__ch" in line for line in filled)
    for here, below in zip(filled, filled[1:]):
        if "Exchange SinglePartition" in here:
            # only the carry table: one aggregated row per chunk
            assert "Aggregate" in below, below


def test_fit_job_counts(spark, sf):
    df = load(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    assert jobs(spark, lambda: features.fit_scale(df, cols, "standard")) <= 2
    assert jobs(spark, lambda: impute.fit_impute(df, {c: "mean" for c in cols})) <= 2
    assert jobs(spark, lambda: outliers.fit_outliers(df, cols, "iqr")) <= 6


def test_full_run_fits_outliers_and_selection_once(spark, monkeypatch):
    """The tables and the plan share the fitted steps, which were fitted twice before."""
    calls = []
    for module, name in ((run.outliers, "fit_outliers"), (run.select, "cascade")):
        whole = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, f=whole, n=name, **k: calls.append(n) or f(*a, **k))
    df = spark.range(300).selectExpr("id", "cast(id % 17 as double) as a", "cast(id % 5 as double) as b", "cast(id % 17 > 8 as int) as y")
    whole = run.full_run(spark, df, PrepConfig(target="y", keys=["id"]), with_models=False)
    assert sorted(calls) == ["cascade", "fit_outliers"]
    assert "selection" in whole.tables and "outliers" in whole.tables


def test_full_run_models_use_its_split(spark, monkeypatch):
    """Every model learns from the train rows of the split stage and is scored on its test rows."""
    learnt, make = {}, run.ml.make_estimator

    def spied(name, *a, **k):
        est = make(name, *a, **k)

        class Spy:
            def fit(self, train):
                learnt[name] = {r["id"] for r in train.select("id").collect()}
                return est.fit(train)

        return Spy()

    monkeypatch.setattr(run.ml, "make_estimator", spied)
    df = spark.range(400).selectExpr("id", "cast(id * 7 % 100 as double) as a", "cast(id % 5 as double) as b", "cast(id * 7 % 100 > 40 as int) as y")
    whole = run.full_run(spark, df, PrepConfig(target="y", keys=["id"], models=["tree", "naive_bayes"], test_size=0.25, val_size=0.25))
    parts = {}
    for r in whole.data.select("id", "split").collect():
        parts.setdefault(r["split"], set()).add(r["id"])
    assert {k: len(v) for k, v in parts.items()} == {"train": 200, "test": 100, "val": 100}
    assert learnt == {"tree": parts["train"], "naive_bayes": parts["train"]}
    assert {n: m.agg(F.sum("n")).head()[0] for n, m in whole.models.confusion.items()} == {"tree": 100, "naive_bayes": 100}


def test_full_run_scores_models_that_hold_a_summary(spark):
    """The run left an Observation in the session, and such models failed when they were scored."""
    df = spark.range(200).selectExpr("id", "cast(id * 7 % 100 as double) as a", "cast(id % 5 as double) as b", "cast(id * 7 % 100 > 40 as int) as y")
    df = df.unionByName(df.limit(20)).unionByName(spark.sql("select 900L as id, 1d as a, 2d as b, cast(null as int) as y"))
    whole = run.full_run(spark, df, PrepConfig(target="y", keys=["id"], models=["logistic"]))
    assert [(r["name"], r["status"]) for r in whole.models.leaderboard.collect()] == [("logistic", "success")]
    counts = {r["item"]: r["value"] for r in whole.tables["summary"].where("item like 'rows_%'").collect()}
    assert counts == {"rows_before": "221", "rows_after": "200", "rows_removed": "21"}
