"""Cutting lineage in storage that survives the loss of executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Directory for checkpoints: the one the session names, a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rollcall-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from the stored rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
