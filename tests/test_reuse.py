"""Plans in a fresh process and on streams, labels by value, JSON layouts, exact samples."""

from __future__ import annotations

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from millrace.operators import chartdata, encode, ml, split, stats
from millrace.plans.fitted import FittedPlan
from millrace.plans.run import relationship_report
from millrace.sources import readers

RELOAD = """
import sys
sys.path.insert(0, sys.argv[1])
from millrace import build_session
from millrace.plans.fitted import FittedPlan
spark = build_session("reload", "local[2]", **{"spark.ui.enabled": "false", "spark.log.level": "ERROR"})
df = spark.read.parquet(sys.argv[3])
print("SUM", FittedPlan.load(spark, sys.argv[2]).transform(df).selectExpr("sum(word)").head()[0])
"""


def test_plan_reloads_in_a_fresh_process(spark, tmp_path):
    df = spark.range(500).select("id", F.concat(F.lit("w"), F.col("id")).alias("word"))
    df.write.parquet(f"{tmp_path}/data")
    step = encode.fit_label(df, "word")
    assert "table" in step.params  # more values than are inlined
    plan = FittedPlan([step])
    plan.save(spark, f"{tmp_path}/plan")
    path = spark._jvm.org.apache.hadoop.fs.Path(step.params["table"])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # the scratch copy goes
    root = str(__import__("pathlib").Path(__file__).resolve().parent.parent)
    out = subprocess.run(
        [sys.executable, "-c", RELOAD, root, f"{tmp_path}/plan", f"{tmp_path}/data"], capture_output=True, text=True, timeout=300
    )
    assert f"SUM {sum(range(500))}" in out.stdout, out.stderr[-2000:]
    stream = FittedPlan.load(spark, f"{tmp_path}/plan").transform(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/data"))
    query = stream.writeStream.format("memory").queryName("reloaded").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("reloaded").selectExpr("sum(word)").head()[0] == sum(range(500))


@pytest.mark.parametrize("values", [[10_000_000, 20_240_131], [0.0005, -3.0], [True, False]])
def test_numeric_labels_by_value(spark, values):
    rows = [(i, values[i % 2], float(i % 2) + 0.01 * (i % 7)) for i in range(120)]
    kind = "boolean" if isinstance(values[0], bool) else "double" if isinstance(values[0], float) else "bigint"
    df = spark.createDataFrame(rows, f"id bigint, y {kind}, x double")
    result = ml.automl_run(df, "y", ["id"], ["x"], ["tree"], task="classification")
    board = result.leaderboard.collect()
    assert board[0]["status"] == "success" and board[0]["score"] == 1.0
    assert sorted(float(v) for v in result.labels) == sorted(float(v) for v in values)


def test_limits_leave_models_on_the_board(spark):
    df = spark.range(60).selectExpr("id", "id % 2 as y", "cast(id % 2 as double) as x")
    board = {r["name"]: r for r in ml.automl_run(df, "y", ["id"], ["x"], ["tree", "logistic"], max_models=1).leaderboard.collect()}
    assert board["tree"]["status"] == "success" and board["logistic"]["status"] == "skipped"
    none = ml.automl_run(df, "y", ["id"], ["x"], ["tree", "logistic"], time_limit=-1.0)
    assert {r["status"] for r in none.leaderboard.collect()} == {"skipped"} and none.best is None


def test_json_layouts_over_several_files(spark, tmp_path):
    for name, docs in {
        "columns": [{"a": {"0": 1, "1": 2}, "b": {"0": 3, "1": 4}}, {"a": {"0": 5, "1": 6}, "b": {"0": 7, "1": 8}}],
        "index": [{"0": {"a": 1, "b": 3}, "1": {"a": 2, "b": 4}}, {"0": {"a": 5, "b": 7}, "1": {"a": 6, "b": 8}}],
        "records": [[{"a": 1, "b": 3}, {"a": 2, "b": 4}], [{"a": 5, "b": 7}, {"a": 6, "b": 8}]],
    }.items():
        folder = tmp_path / name
        folder.mkdir()
        for i, doc in enumerate(docs):
            (folder / f"{i}.json").write_text(json.dumps(doc))
        rows = readers.read_json(spark, str(folder)).select("a", "b").collect()
        assert sorted(map(tuple, rows)) == [(1, 3), (2, 4), (5, 7), (6, 8)], name
    (tmp_path / "unclear.json").write_text('{"r1": {"x": 1}, "r2": {"x": 2}}')
    with pytest.raises(ValueError):
        readers.read_json(spark, str(tmp_path / "unclear.json"))
    assert readers.read_json(spark, str(tmp_path / "unclear.json"), "index").columns == ["x"]


def test_samples_are_exact_with_repeated_keys(spark):
    df = spark.range(1000).selectExpr("id % 50 as k", "id % 7 as v")
    for n in (0, 1, 5, 333, 1000, 2000):
        assert split.sample_n(df, ["k"], n).count() == min(n, 1000)
    with pytest.raises(ValueError):
        relationship_report(spark, df, sample=10)


def test_outlier_points_are_all_returned(spark):
    df = spark.range(3000).selectExpr("cast(case when id < 400 then 1000000 + id else id % 10 end as double) as x")
    assert chartdata.box_points(df, ["x"]).count() == 400
    assert chartdata.box_points(df, ["x"], 50).count() == 50


def test_overview_tells_gaps_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, None), (None, None), (None, None)], "a int, b int")
    assert stats.overview(df).head()["duplicate_rows"] == 2
