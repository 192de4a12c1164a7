"""Joins that stay balanced when a few keys hold a large share of the rows.

Both joins rest on one counting argument: of rows that weigh ``W`` together, fewer
than ``m`` keys can each weigh more than ``W / m``.  The heavy keys therefore always
fit a broadcast of known size, whatever the data, and the remaining keys are each
too light to unbalance a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termweave.runtime import shuffle_partitions, stored

# At most about this many rows are broadcast by ``lookup_join``, and split by ``balanced_join``; more
# where the shuffle is so wide that lighter keys would stand out, too.
LOOKUP_HEAVY_KEYS = 100_000
SPLIT_HEAVY_KEYS = 10_000
# Longer keys are broadcast as a digest of fixed size.
SHORT_KEY_BYTES = 64
# A split key is cut into cells of at most about this many rows a side.
SPLIT_CELL_ROWS = 20_000
# Where the result is kept in memory behind the join, a task makes about so many rows of it, from cells of so many rows a side.
TASK_RESULT_ROWS = 2_000_000
TASK_CELL_ROWS = 1_000


def _share(df: DataFrame, least: int) -> int:
    """So many keys that those outside weigh less than half a mean shuffle partition."""
    return max(least, 2 * shuffle_partitions(df))


def _bounded(df: DataFrame, key: str) -> Column:
    """``key``, or what stands for it in few bytes; a digest is longer than any key kept as it is."""
    kind = df.schema[key].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = F.col(key).cast("binary")
        digest = F.concat(F.lit("sha2:"), F.sha2(raw, 256)).cast("binary")
        return F.when(F.octet_length(key) <= SHORT_KEY_BYTES, raw).otherwise(digest)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.sha2(F.to_json(key), 256)
    return F.col(key)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    heavy_keys: int | None = None,
) -> DataFrame:
    """Inner join of ``facts`` with ``lookup``, which has one row per ``key``.

    ``weight`` is a column of ``lookup`` that bounds the number of facts of the key.
    Facts of heavy keys meet a broadcast and are not shuffled at all; in text they
    are most of the rows.  Only the light rest is shuffled on ``key``.  Both inputs are
    read more than once: pass ``stored`` tables where they are dear to compute.
    """
    heavy_keys = heavy_keys or _share(facts, LOOKUP_HEAVY_KEYS)
    total = lookup.agg(F.sum(weight)).scalar()
    is_heavy = F.col(weight).cast("double") * heavy_keys > total
    heavy = lookup.where(is_heavy).withColumn("_short", _bounded(lookup, key)).drop(key)
    light = lookup.where(~is_heavy)
    short = facts.withColumn("_short", _bounded(facts, key))
    columns = [*facts.columns, *(c for c in lookup.columns if c != key)]
    met = short.join(F.broadcast(heavy), "_short").select(*columns)
    rest = short.join(F.broadcast(heavy.select("_short")), "_short", "left_anti").drop("_short")
    return met.unionByName(rest.join(light, key).select(*columns))


def key_sizes(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``(_digest, l, r)``: number of rows of either side with the key.  A stored table, made of the key columns alone."""
    digest = F.xxhash64(*on).alias("_digest")
    sides = left.select(digest, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(digest, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return stored(sides.groupBy("_digest").agg(F.sum("l").alias("l"), F.sum("r").alias("r")))


def result_tasks(sizes: DataFrame, task_rows: int = TASK_RESULT_ROWS, *, besides: float = 0.0) -> int:
    """Number of tasks that make about ``task_rows`` rows of a join each; the shuffle width at least.

    ``besides`` are rows of keys that are not among the ``sizes``.
    """
    result = sizes.agg(F.sum(F.col("l").cast("double") * F.col("r"))).first()[0]
    return max(shuffle_partitions(sizes), math.ceil(((result or 0) + besides) / task_rows))


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    heavy_keys: int | None = None,
    cell_rows: int = SPLIT_CELL_ROWS,
    *,
    sizes: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Inner equi-join of two sides that may both hold many rows of one key.

    A key that has more than its share of the rows or of the result is cut into a
    grid: its left rows are dealt to ``l`` cells, its right rows to ``r`` cells, and
    every left cell meets every right cell once.  A row is repeated once per opposite
    cell, at most one copy per ``cell_rows`` result rows.  All other keys have one cell.

    Keys are of the same types on both sides.  They are counted by a 64-bit digest, so keys of
    any length and type can be split; two keys of one digest are just cut alike.  The counts
    are stored once, read from the key columns alone, or are ``sizes`` if given.  Equal rows of a side share a cell.

    ``tasks`` sets the number of tasks.  The keys that are not split then make less than half a mean task's result each.
    """
    heavy_keys = heavy_keys or max(_share(left, SPLIT_HEAVY_KEYS), 2 * (tasks or 0))
    digest = F.xxhash64(*on).alias("_digest")
    sizes = key_sizes(left, right, on) if sizes is None else sizes
    rows = F.col("l").cast("double") + F.col("r")
    result = F.col("l").cast("double") * F.col("r")
    total = sizes.agg(F.struct(F.sum(rows).alias("rows"), F.sum(result).alias("result"))).scalar()
    above_share = (rows * heavy_keys > total.getField("rows")) | (
        result * heavy_keys > total.getField("result")
    )
    cells = [
        F.greatest(F.lit(1), F.ceil(F.col(side) / cell_rows)).cast("int").alias(f"{side}_cells")
        for side in ("l", "r")
    ]
    heavy = F.broadcast(
        sizes.where((F.greatest("l", "r") > cell_rows) & above_share).select("_digest", *cells)
    )

    def deal(side: DataFrame, own: str, other: str) -> DataFrame:
        own_cells, other_cells = (F.coalesce(f"{c}_cells", F.lit(1)) for c in (own, other))
        return side.withColumn("_digest", digest).join(heavy, "_digest", "left").select(
            *side.columns,
            F.pmod(F.xxhash64(*side.columns), own_cells).cast("int").alias(f"{own}_cell"),
            F.explode(F.sequence(F.lit(0), other_cells - 1)).alias(f"{other}_cell"),
        )

    cell = [*on, "l_cell", "r_cell"]
    l, r = deal(left, "l", "r"), deal(right, "r", "l")
    if tasks:  # else the rows that go in decide, however many come out
        l, r = l.repartition(tasks, *cell), r.repartition(tasks, *cell)
    return l.join(r, cell).drop("l_cell", "r_cell")
