"""Session defaults and the few helpers that look at the session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "codeloom", cpus: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    n = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CODELOOM_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder: the one the cluster names, or a fresh one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="codeloom-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back, so that a lost executor costs a reread."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
