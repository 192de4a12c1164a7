"""What several operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder name where driver and executors can both write.

    Below ``spark.checkpoint.dir`` as the session has it; a session without that setting
    uses its warehouse, which a cluster shares as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_intermediate"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


# Bytes of an Arrow batch to a Python worker while tables are written, at most.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, and columns are pruned.

    Workers get smaller batches than by default meanwhile, as long texts weigh much more in Python.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, unless they can be expected to import it anyway.

    Where it is neither on ``PYTHONPATH`` nor in the working folder, Spark serves an archive of its
    sources from the driver.
    """
    package = Path(__file__).resolve().parents[1]
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if str(package.parent) in paths or context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fraction(*key: Column | str) -> Column:
    """A number in [0, 1) that the key alone decides."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 40)) / F.lit(float(1 << 40))


def gapless_ranks(
    rows: DataFrame,
    group: str,
    order: list[str],
    n_rows: int,
    cell_rows: int = 20_000,
    row: str | None = None,
) -> DataFrame:
    """``rows`` with ``rank``, which counts the rows of each group from 0 without a gap.

    A group may hold all rows: it is dealt by a hash of ``order`` to cells, numbered inside
    each cell, and shifted by the sizes of the cells before.  Both a cell and the list of
    cells of a group stay near the square root of very large inputs.  Rows that agree in ``order`` share a cell,
    unless ``row`` names a column of numbers that stay with their rows: then more than a cell's worth of such rows are spread.
    """
    cells = max(1, min(100_000, n_rows // cell_rows))
    digest = F.xxhash64(*order)
    cell = F.pmod(digest, F.lit(cells))
    dealt = rows
    if row is not None:
        counts = rows.groupBy(digest.alias("_digest")).agg(F.count("*").alias("_same"))
        # At most one in cell_rows of the rows is a key here.
        many = counts.where(F.col("_same") > cell_rows)
        dealt = rows.withColumn("_digest", digest).join(F.broadcast(many), "_digest", "left")
        parts = F.coalesce(F.ceil(F.col("_same") / cell_rows), F.lit(1))
        cell = F.pmod(F.col("_digest") + F.pmod(F.col(row), parts), F.lit(cells))
    dealt = dealt.select(*rows.columns, cell.alias("_cell"))
    earlier = W.partitionBy(group).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    before = (
        dealt.groupBy(group, "_cell")
        .agg(F.count("*").alias("_n"))
        .select(group, "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = [*order, row] if row is not None else order
    inside = F.row_number().over(W.partitionBy(group, "_cell").orderBy(*within)).cast("bigint")
    return (
        dealt.join(before, [group, "_cell"])
        .withColumn("rank", F.col("_before") + inside - 1)
        .drop("_cell", "_before")
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one made from it that is no column of ``df``."""
    while name in df.columns:
        name = f"_{name}"
    return name


def if_small(keys: DataFrame, rows: int = 500_000) -> DataFrame:
    """``keys``, with a hint to broadcast if they are few; else Spark shuffles both sides.

    For narrow rows of at most some 50 bytes, which are counted first.
    """
    return F.broadcast(keys) if keys.count() <= rows else keys


class Memo(dict):
    """Results of ``make`` by string; beyond ``limit`` entries it computes without keeping.

    Words follow Zipf's law, so the frequent ones are in early.  Long strings are never kept.
    """

    def __init__(self, make: Callable[[str], object], limit: int, longest: int = 48):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, key: str):
        value = self.make(key)
        if len(self) < self.limit and len(key) <= self.longest:
            self[key] = value
        return value


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, before which the Python process drops what others kept, and after which it gives back its memory.

    Processes outlive tasks.  What they keep would add up with that of other stages, and of the JVM beside them.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        if _KEPT:
            release()
        try:
            yield from work(batches)
        finally:
            release()

    return run


def release() -> None:
    """Drop what ``once`` keeps, and give memory that Python no longer uses back to the system, where the C library can."""
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_KEPT: list = []


def once(key: tuple, make: Callable[[], object]):
    """``make()``, kept for later tasks of the same Python process.

    Only the latest key's is kept, until a ``tidy`` task of another operator, so that what operators remember does not add up.
    """
    if not _KEPT or _KEPT[0] != key:
        _KEPT.clear()
        _KEPT.extend((key, make()))
    return _KEPT[1]
