"""Where intermediate results are kept when a plan reads them more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir") + "/_intermediate"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


# Parquet options for sorted numbers, of which only the differences are kept.
SORTED_NUMBERS = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}
# For tables of texts or many numbers, where disk counts for more than the time to write them.
SMALL = {"compression": "zstd"}


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: later readers take only the columns they need."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there, partitions kept.

    The folder is the session's ``spark.checkpoint.dir``.  A session without that setting uses
    its warehouse, which driver and executors share as well.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir") + "/_intermediate")
    return df.checkpoint()


def shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle width, for exchanges whose work is not measured by their bytes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
