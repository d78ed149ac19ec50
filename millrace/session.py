"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by the cluster; a private one only for local masters."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder that every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for a table written by a job."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def parallelism(spark: SparkSession) -> int:
    """Target number of tasks for one pass over a large table."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
        spark.sparkContext.defaultParallelism,
    )
