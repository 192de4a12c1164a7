"""Embedding whitening by spectral divide and conquer on QDWH polar decompositions.

The polar factor ``U`` of ``A - s I`` has eigenvalue 1 where that of a symmetric ``A`` is above ``s``, and -1
below, so ``(I + U) / 2`` projects on the invariant subspace above the shift.  ``A`` is compressed to this subspace
and to its complement, and both are split again until the parts are single components.  ``U`` is found by the
dynamically weighted Halley iteration, whose steps are QR factorisations of the stacked iterate and identity.
Only subspaces that hold one of the asked components are split further.

Vectors are scaled to whole numbers, so that everything that depends on all rows is exact: sums per dimension, then
products of entries centred at the rounded means, are added as integers; the covariance is rounded once, when
the exact numerators are divided.  What comes to the driver is one covariance, a number per pair of dimensions.
The components are broadcast, and every row is whitened by itself.

Out stay rows with a null, empty or non-finite vector, those with an entry whose whole number is 2^53 or more, and
those with another number of dimensions than most rows.  Rows that repeat an id are rows of their own, null ids stay.
Components with no variance have no whitened value and give no rows; a table of equal vectors, or an empty one, gives none at all.
Of equal eigenvalues any basis of their subspace is right.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import tidy, written
from termweave.llm.vectors import finite

EXACT = 1 << 53
# A component with less of the total variance than this has none.
NO_VARIANCE = 1e-13


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, by QDWH."""
    n = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return np.eye(n)
    x = a / size
    # Any lower bound of the smallest singular value will do; a low one costs a step or two.
    low = np.finfo(float).eps / np.sqrt(n)
    eye = np.eye(n)
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        a_k = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        b_k = (a_k - 1) ** 2 / 4
        c_k = a_k + b_k - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c_k) * x, eye]))
        before = x
        x = (b_k / c_k) * x + (a_k - b_k / c_k) / np.sqrt(c_k) * (q[:n] @ q[n:].T)
        x = (x + x.T) / 2
        low = min(1.0, low * (a_k + b_k * square) / (1 + c_k * square))
        if np.linalg.norm(x - before) < 1e-15 * n * n + 1e-14 and 1 - low < 1e-14:
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthonormal basis whose first columns span the subspace above a shift, and their number.

    None if the matrix is a multiple of the identity as far as doubles tell.
    """
    n = len(a)
    rng = np.random.default_rng(n)
    size = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    if size <= 1e-15 * n * np.linalg.norm(a):
        return None
    best = None
    diagonal = np.diag(a)
    # The mean is always between the smallest and the largest eigenvalue, the median cuts better.
    shifts = [np.median(diagonal), diagonal.mean()]
    shifts += [diagonal.mean() + size / np.sqrt(n) * t for t in (-0.3, 0.3, -0.1, 0.1)]
    for shift in shifts:
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n:
            continue
        basis, _ = np.linalg.qr(projector @ rng.standard_normal((n, n)))
        # Range first, then its complement; once more, as random columns may lean on one another.
        basis, _ = np.linalg.qr(np.hstack([projector @ basis[:, :rank], basis[:, rank:] - projector @ basis[:, rank:]]))
        left = np.linalg.norm(basis[:, rank:].T @ a @ basis[:, :rank])
        if best is None or left < best[0]:
            best = (left, basis, rank)
        if left <= 1e-14 * n * np.linalg.norm(a):
            break
    return None if best is None else best[1:]


def eigen(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their vectors as columns."""
    parts: list[np.ndarray] = []

    def descend(basis: np.ndarray) -> None:
        if sum(part.shape[1] for part in parts) >= k:
            return
        inner = basis.T @ a @ basis
        cut = None if len(inner) == 1 else _split((inner + inner.T) / 2)
        if cut is None:
            parts.append(basis)
            return
        turned, rank = basis @ cut[0], cut[1]
        descend(turned[:, :rank])
        descend(turned[:, rank:])

    if len(a):
        descend(np.eye(len(a)))
    if not parts:
        return np.zeros(0), np.zeros((len(a), 0))
    vectors, _ = np.linalg.qr(np.hstack(parts))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], vectors[:, order]


def exact_products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` of whole numbers, exact, as Python integers where 64 bits may not do."""
    most = int(np.abs(x).max(initial=0))
    if most * most * max(1, len(x)) < EXACT:
        return (x.T @ x).astype(np.int64)
    if len(x) > 1 and most * most < EXACT:
        half = len(x) // 2
        return exact_products(x[:half]).astype(object) + exact_products(x[half:])
    whole = np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
    return whole.T @ whole


def _rows_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)


def _sums(rows: DataFrame) -> tuple[int, list[int], int, int]:
    """Number of rows, and per dimension the exact sum; the least and the largest entry."""

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, least, most = 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            # Halves, so that sums of very large entries stay within 64 bits.
            here = np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
            total = here if total is None else total + here
            least = x.min() if least is None else min(least, x.min())
            most = x.max() if most is None else max(most, x.max())
            n += batch.num_rows
        if n:
            dims = total.shape[1]
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": np.arange(dims, dtype=np.int32),
                    "high": total[0],
                    "low": total[1],
                    "least": np.full(dims, least, dtype=np.int64),
                    "most": np.full(dims, most, dtype=np.int64),
                    "n": np.full(dims, n, dtype=np.int64),
                }
            )

    parts = rows.select("x").mapInArrow(add, "dim int, high long, low long, least long, most long, n long")
    got = (
        parts.groupBy("dim")
        .agg(F.sum("high"), F.sum("low"), F.min("least"), F.max("most"), F.sum("n"))
        .orderBy("dim")
        .collect()  # a row per dimension
    )
    sums = [(row[1] << 32) + row[2] for row in got]
    return (got[0][5], sums, min(r[3] for r in got), max(r[4] for r in got)) if got else (0, [], 0, 0)


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of all rows, each entry its exact value rounded once."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    middle = np.array(centre, dtype=float)

    @tidy
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                here = exact_products(_rows_of(batch) - middle).astype(object)
                total = here if total is None else total + here
        if total is not None:
            i, j = np.triu_indices(len(total))
            entries = total[i, j]
            # As text, because a product may have more than 64 bits.
            yield pa.RecordBatch.from_pydict(
                {
                    "i": i.astype(np.int32),
                    "j": j.astype(np.int32),
                    "product": pa.array([str(int(v)) for v in entries]),
                }
            )

    parts = rows.select("x").mapInArrow(multiply, "i int, j int, product string")
    exact = F.sum(F.col("product").cast("decimal(38,0)")).cast("string")
    products = parts.groupBy("i", "j").agg(exact.alias("product")).collect()  # a row per pair of dimensions
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((len(sums), len(sums)))
    for i, j, product in products:
        value = float(Fraction(n * int(product) - rest[i] * rest[j], n * n))
        out[i, j] = out[j, i] = value
    return out


def whiten(
    vectors: DataFrame, components: int = 8, scale: float = 1024.0, offset: int = 100_000
) -> DataFrame:
    """``(vec_id, n, deviation, whitened, explained, identity_error)`` of ``(vec_id, embedding)``.

    ``whitened`` and ``explained`` are arrays over the components, the first one of largest variance.  ``deviation``, a whole
    number of up to 38 digits, is the sum of squares of ``n`` times each entry less its dimension's sum.
    """
    spark = vectors.sparkSession
    result = (
        "vec_id long, n long, deviation decimal(38,0), whitened array<double>,"
        " explained array<double>, identity_error double"
    )
    whole = F.transform("v", lambda v: F.floor(v * F.lit(scale)))
    fine = finite(vectors).where(F.forall("v", lambda v: F.abs(v * F.lit(scale)) < float(EXACT >> 1)))
    rows = written(fine.select("vec_id", F.transform(whole, lambda v: v.cast("bigint") + F.lit(offset)).alias("x")))
    n, sums, least, most = _sums(rows)
    if not n:
        return spark.createDataFrame([], result)
    covariance = _covariance(rows, n, sums)
    values, directions = eigen(covariance, components)
    trace = float(np.trace(covariance))
    kept = values > NO_VARIANCE * trace
    values, directions = values[kept], directions[:, kept]
    if not len(values):
        return spark.createDataFrame([], result)
    # One covariance's worth of numbers, whatever the number of rows.
    model = spark.sparkContext.broadcast((directions / np.sqrt(values), sums))
    largest = max(abs(n * v - s) for v in (least, most) for s in (min(sums), max(sums)))
    narrow = max(largest * largest * len(sums), *map(abs, sums)) < 1 << 63

    @tidy
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, totals = model.value
        exact = np.array(totals, dtype=np.int64 if narrow else object)
        # x - S/n as a whole number and a rest below one, so nothing is lost before the product.
        centre = [(2 * s + n) // (2 * n) for s in totals]
        rest = np.array([float(Fraction(s - n * c, n)) for s, c in zip(totals, centre, strict=True)])
        middle = np.array(centre, dtype=float)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows_of(batch)
            whitened = (x - middle - rest) @ weights
            if narrow:
                apart = n * x.astype(np.int64) - exact
                deviation = (apart * apart).sum(axis=1)
            else:
                deviation = [
                    sum((n * int(v) - s) ** 2 for v, s in zip(row, totals, strict=True)) for row in x
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array([str(d) for d in deviation]),
                    pa.array(list(whitened), pa.list_(pa.float64())),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    white = written(rows.mapInArrow(project, "vec_id long, deviation string, whitened array<double>"))
    # How far the covariance of what was written is from the identity.
    size = len(values)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    entry = [F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) for i, j in pairs]
    apart = white.select(*(F.abs(e - F.lit(float(i == j))) for e, (i, j) in zip(entry, pairs, strict=True)))
    error = float(max(apart.first()))  # one row
    return white.select(
        "vec_id",
        F.lit(n).cast("bigint").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.array(*(F.lit(float(v / trace)) for v in values)).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def per_component(whitened: DataFrame) -> DataFrame:
    """The rows of ``whiten``, one per row and component, which are numbered from 1."""
    both = F.arrays_zip("whitened", "explained")
    flat = whitened.select(
        "vec_id", "n", "deviation", "identity_error", F.posexplode(both).alias("at", "part")
    )
    return flat.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        "identity_error",
    )
