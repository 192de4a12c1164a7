"""One row per array element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termweave.runtime import stored


def computed_once(expression: Column, name: str) -> Column:
    """``expression`` as a column that filters on it read, and do not compute again.

    The optimizer moves a filter below a projection, and below an aggregate, by repeating the expressions of its columns there.
    It does not move one below a generator.
    """
    return F.explode(F.array(expression)).alias(name)


def unnest(rows: DataFrame, array: str, item: str, position: str | None = None) -> DataFrame:
    """Replace ``array`` by its elements, and their 0-based positions if a name is given.

    Same rows as a plain ``explode``.  That one makes the optimizer filter empty arrays
    first, by a condition that repeats the expression of the array: every text would be
    tokenized twice.
    """
    kept = [column for column in rows.columns if column != array]
    names = [item] if position is None else [position, item]
    generate = F.explode_outer if position is None else F.posexplode_outer
    return rows.select(*kept, generate(array).alias(*names)).where(F.col(item).isNotNull())


def summed_before(counts: DataFrame, n: str, *by: str) -> DataFrame:
    """``counts`` with ``_before``, the sum of ``n`` over the rows before.  All in one task: for a row per partition or file."""
    earlier = W.orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum(n).over(earlier), F.lit(0)))


def places(rows: DataFrame, at: Column) -> tuple[DataFrame, Column]:
    """Rows and the expression of their place, from 0, by a column of ``monotonically_increasing_id``.

    The ids must have been written with the rows.  Rows are counted per partition; only those counts, a
    row per partition, are summed in one task and broadcast.
    """
    kept = rows.withColumn("_part", F.shiftright(at, 33))
    counts = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    before = summed_before(counts, "_n", "_part").select("_part", "_before")
    place = F.col("_before") + at.bitwiseAND((1 << 33) - 1)
    return kept.join(F.broadcast(before), "_part"), place


def in_order(rows: DataFrame, place: str, *by: str) -> DataFrame:
    """``rows`` with their ``place``, from 0 without a gap, in one order of all rows."""
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    written = stored(ranged.withColumn("_at", F.monotonically_increasing_id()))
    known, number = places(written, F.col("_at"))
    return known.select(*rows.columns, number.alias(place))
