"""Writing tables, split data sets, results and fitted objects."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from millrace.plans.fitted import FittedPlan


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").csv(path, header=True, sep=sep)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_split_dataset(df: DataFrame, path: str, target: str, features: list[str]) -> str:
    """Parts as partitions of one table beside a one-row metadata JSON."""
    df.write.mode("overwrite").partitionBy("split").parquet(f"{path}/data")
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    meta = json.dumps({"target": target, "features": features, "rows": counts})
    df.sparkSession.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def read_split_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    meta = json.loads(spark.read.text(f"{path}/metadata").head()[0])
    return spark.read.parquet(f"{path}/data"), meta


def write_results_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def save_fitted(spark: SparkSession, path: str, plan: FittedPlan, model: PipelineModel | None = None) -> str:
    plan.save(spark, f"{path}/plan")
    if model is not None:
        model.write().overwrite().save(f"{path}/model")
    return path


def load_fitted(spark: SparkSession, path: str, with_model: bool = False):
    plan = FittedPlan.load(spark, f"{path}/plan")
    return (plan, PipelineModel.load(f"{path}/model")) if with_model else plan


def write_tables(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """Every named table of a report below one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
    return sorted(tables)

