"""Counting inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bag(ordered: Column) -> Column:
    """Run lengths of a sorted, non-empty array: ``ARRAY<STRUCT<item, n>>``, one entry per item.

    Linear in the array.  Sort in an earlier projection, so that the lambda below
    reads a finished column instead of sorting once per element.
    """
    starts = F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)),
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(ordered)), F.array(F.size(ordered)))
    return F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda run: F.struct(
            F.get(ordered, run["a"]).alias("item"),
            (run["b"] - run["a"]).cast("bigint").alias("n"),
        ),
    )
