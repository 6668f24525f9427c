"""What a checkpoint was made of, written beside it when it is complete, and verified before it is used.

The manifest names the checkpoint's rows by count and digest, its columns, and the files it was made from by path, length and time. It is
taken away (overwritten as incomplete) before a checkpoint is written and written anew after it, so a run that stops
in between, a folder that something else has written, and inputs that have changed since are all told apart from a whole checkpoint.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CheckpointUnverified(Exception):
    """The checkpoint is missing, incomplete, not the one its manifest names, or made from other inputs."""


def manifest_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.manifest"


def contents(df: DataFrame) -> dict:
    """Rows and an order-free digest of all columns, summed in the tasks."""
    digest = F.sum(F.xxhash64(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in df.columns)).cast("decimal(38,0)"))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(digest, F.lit(0)).alias("digest")).first()
    return {"rows": found.rows, "digest": str(found.digest), "columns": df.columns}


def fingerprint(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """A digest of the files under each path: their paths, lengths and times, no contents. A path without files has none."""
    out = {}
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
            out[path] = contents(files)["digest"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            out[path] = ""
    return out


def _write(spark: SparkSession, checkpoint: str, facts: dict) -> None:
    row = spark.createDataFrame([(json.dumps(facts, sort_keys=True),)], "facts string")
    row.coalesce(1).write.mode("overwrite").parquet(manifest_path(checkpoint))


def begin(spark: SparkSession, checkpoint: str) -> None:
    _write(spark, checkpoint, {"complete": False})


def complete(spark: SparkSession, checkpoint: str, written: DataFrame, inputs: dict[str, str]) -> None:
    _write(spark, checkpoint, {"complete": True, "contents": contents(written), "inputs": inputs})


def verify(spark: SparkSession, checkpoint: str, read: DataFrame) -> None:
    """Fails unless ``read`` is what the manifest names and the inputs are as they were."""
    try:
        facts = json.loads(spark.read.schema("facts string").parquet(manifest_path(checkpoint)).first()[0])
    except (AnalysisException, TypeError) as error:
        raise CheckpointUnverified(f"{checkpoint} has no manifest") from error
    if not facts["complete"]:
        raise CheckpointUnverified(f"{checkpoint} was not written to its end")
    if facts["contents"] != contents(read):
        raise CheckpointUnverified(f"{checkpoint} is not the one its manifest names")
    now = fingerprint(spark, list(facts["inputs"]))
    changed = [path for path, digest in facts["inputs"].items() if now[path] != digest]
    if changed:
        raise CheckpointUnverified(f"{checkpoint} was made from other inputs: {', '.join(changed)}")
