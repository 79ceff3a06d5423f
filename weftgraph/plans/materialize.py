"""Cutting lineage in loops, on storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session, setting one only where none is set.

    A machine-local folder is accepted for a local master only: on a cluster an executor
    that is lost would take its part of the checkpoint with it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        if current.startswith("file:") and not context.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", None):
            raise RuntimeError(f"{current} is local to a machine; set spark.checkpoint.dir to a folder shared by all executors")
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="weftgraph-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the checkpoint folder and read back: columns are pruned and sizes are known."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/weftgraph/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it on reliable storage and forget how it was made.

    Used between the rounds of a frontier loop, where the plan would otherwise double with
    every round, and where a value such as a partition number must not change if a task is
    run a second time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
