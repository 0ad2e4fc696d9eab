"""Catalog tables and Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet folder when the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)
