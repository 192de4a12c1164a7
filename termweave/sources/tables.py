"""Parquet tables as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns of a parquet table; Spark's settings decide the splits."""
    return spark.read.parquet(path).select(*columns)
