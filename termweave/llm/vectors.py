"""Vectors as tables and as packed blocks, for the two searches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import fraction

def finite(vectors: DataFrame, *kept: str) -> DataFrame:
    """``(vec_id, v)`` and the columns ``kept`` of ``(vec_id, embedding, ...)``, with double components.

    Out stay null and empty vectors, those with a null or non-finite component, and those of
    another length than most have (of several such lengths, the smallest counts).
    """
    big = F.lit(float("inf"))
    fine = F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)), F.lit(False)
    )
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
        *kept,
    )
    rows = rows.where("v IS NOT NULL").where(fine & (F.size("v") > 0))
    # One row.
    common = (
        rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    )
    return rows.where(F.size("v") == common[0]["n"]) if common else rows


def sampled(rows: DataFrame, n_rows: int, size: int) -> np.ndarray:
    """About ``size`` vectors of numbered rows, picked by a hash of their number; at most twice as many."""
    if not n_rows:
        return np.zeros((0, 0))
    picked = rows.where(fraction("row") < size / n_rows).orderBy("vec_id", "row").limit(2 * size)
    got = [row["v"] for row in picked.select("v").collect()]
    if not got:
        got = [row["v"] for row in rows.orderBy("vec_id", "row").limit(size).select("v").collect()]
    return np.array(got, dtype=float)


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def packed(ids: np.ndarray, rows: np.ndarray) -> dict:
    return {
        "ids": np.asarray(ids, dtype="<i8").tobytes(),
        "rows": np.ascontiguousarray(rows, dtype="<f8").tobytes(),
    }


def unpacked(ids: bytes, rows: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, "<i8")
    return keys, np.frombuffer(rows, "<f8").reshape(len(keys), -1)
