"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; how many splits it has is a matter of the session's settings."""
    return spark.read.parquet(path)
