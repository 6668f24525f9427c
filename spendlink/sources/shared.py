"""Where intermediate data may be kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder if the session names one; otherwise a fresh local folder, for local runs only."""
    context = spark.sparkContext
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    current = context.getCheckpointDir()
    if current:
        return shared or current
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="spendlink-")
    context.setCheckpointDir(shared)
    return shared


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/spendlink-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, go on from the written table.

    For results used more than once: later steps read only the columns they need, plans stay short, and a lost
    executor costs a re-read instead of a recomputation.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
