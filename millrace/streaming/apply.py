"""A fitted plan on a stream.

The plan is a chain of projections and joins with static dictionaries, so the
stream needs no state and no watermark; each micro-batch gives exactly what the
batch run gives for the same rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from millrace.plans.fitted import FittedPlan
from millrace.session import scratch_dir


def read_stream(spark: SparkSession, path: str, schema=None, fmt: str = "parquet", glob: str | None = None, **options) -> DataFrame:
    schema = schema or spark.read.format(fmt).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def apply_fitted(df: DataFrame, plan: FittedPlan, model: PipelineModel | None = None) -> DataFrame:
    """The same call for batch and streaming frames."""
    out = plan.transform(df)
    return model.transform(out) if model is not None else out


def write_stream(df: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True):
    """Exactly-once parquet sink; ``available_now`` ends when the input is done."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path}-checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def run_to_table(df: DataFrame, name: str = "stream") -> DataFrame:
    """Drain a stream into a table in the scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    query = write_stream(df, path)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)
