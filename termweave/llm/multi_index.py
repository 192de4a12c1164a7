"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the unit vectors have a codebook of their own; a cell is a pair of centroids.  For a
query, centroids of each half are sorted by distance, and a heap walks the pairs by summed distance
until the cells hold enough rows.  Those are ranked by their exact cosine.

Codebooks are fitted on a bounded sample (``SAMPLE`` rows); every row is indexed.  How many rows are
enough is a share of all, the smallest with recall ``RECALL`` on that sample against brute force there.
Cells are packed in blocks of at most about ``BLOCK_ROWS`` rows, and a query goes to all blocks of
its cells, so a cell may hold any share of the rows.

Out stay rows with a null id, vectors of zeros, and vectors as ``vectors.finite`` says.  Rows that repeat an id are
rows of their own.  Ties go to the smaller id.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termweave.llm.common import written
from termweave.llm.vectors import finite, matrix, packed, sampled, unpacked

SAMPLE = 12_000
CELL_ROWS = 200
LARGEST_CODEBOOK = 256
RECALL = 0.95
BLOCK_ROWS = 2_048
QUERY_ROWS = 512
SLACK = 1e-9


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (
        (rows**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None] - 2 * rows @ centres.T
    )


def codebook(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids by Lloyd's rounds from rows spread over the sample."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = _distances(rows, centres).argmin(axis=1)
        for at in range(k):
            if (mine := nearest == at).any():
                centres[at] = rows[mine].mean(axis=0)
    return centres


class Index:
    """Codebooks of the two halves."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.books = [codebook(part, k) for part in self.halves(sample)]

    def halves(self, rows: np.ndarray) -> list[np.ndarray]:
        return [rows[:, : self.half], rows[:, self.half :]]

    @property
    def size(self) -> int:
        return len(self.books[0])

    def cells(self, rows: np.ndarray) -> np.ndarray:
        first, second = (
            _distances(part, book).argmin(axis=1)
            for part, book in zip(self.halves(rows), self.books, strict=True)
        )
        return first * self.size + second

    def traverse(self, query: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
        """Cells by summed distance of their centroids, until they hold ``enough`` rows."""
        tables = [
            _distances(part, book)[0]
            for part, book in zip(self.halves(query[None]), self.books, strict=True)
        ]
        orders = [np.argsort(t, kind="stable") for t in tables]
        sorted_ = [t[o].tolist() for t, o in zip(tables, orders, strict=True)]
        order_a, order_b = (o.tolist() for o in orders)
        k, found, held = self.size, [], 0
        heap = [(sorted_[0][0] + sorted_[1][0], 0, 0)]
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = order_a[i] * k + order_b[j]
            if counts[cell]:
                found.append(cell)
                held += int(counts[cell])
            # Each pair is pushed by one of its two predecessors only.
            if i + 1 < k:
                heapq.heappush(heap, (sorted_[0][i + 1] + sorted_[1][j], i + 1, j))
            if i == 0 and j + 1 < k:
                heapq.heappush(heap, (sorted_[0][0] + sorted_[1][j + 1], 0, j + 1))
        return found


def unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one vector with others; equal rows get equal results."""
    query = query / np.abs(query).max()
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    dots = (rows * query).sum(axis=1)
    return dots / np.sqrt((rows * rows).sum(axis=1)) / np.sqrt((query * query).sum())


def share_needed(index: Index, sample: np.ndarray, k: int, recall: float) -> float:
    """The smallest share of the rows that reaches the recall on the sample."""
    if len(sample) <= 4 * k:
        return 1.0
    queries = np.unique(np.linspace(0, len(sample) - 1, 200).astype(int))
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=index.size**2)
    needed = []
    for at in queries:
        near = sample @ sample[at]
        near[at] = -np.inf
        place = np.empty(index.size**2, dtype=float)
        place[:] = len(sample)
        walked = index.traverse(sample[at], counts, len(sample))
        place[walked] = np.cumsum(counts[walked])
        needed += place[cells[np.argpartition(-near, k)[:k]]].tolist()
    return min(1.0, float(np.quantile(needed, recall)) / len(sample))


def search(vectors: DataFrame, every: int = 50, k: int = 5, recall: float = RECALL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: neighbours of the rows whose id ``every`` divides."""
    spark = vectors.sparkSession
    fine = finite(vectors).where(F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0))
    # Numbered as written, so that rows that repeat an id stay apart.
    rows = written(fine.withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    sample = sampled(rows, n, SAMPLE)
    schema = "query_row long, query_id long, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = unit(sample)
    size = min(LARGEST_CODEBOOK, len(sample), max(1, round((n / CELL_ROWS) ** 0.5)))
    index = Index(sample, size)
    # Two codebooks of bounded size.
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=shared.value.cells(unit(matrix(batch["v"]))))

    indexed = written(rows.mapInPandas(assign, "vec_id long, v array<double>, row long, cell int"))
    counts = np.zeros(size * size, dtype=np.int64)
    for row in indexed.groupBy("cell").count().collect():  # at most LARGEST_CODEBOOK ** 2
        counts[row["cell"]] = row["count"]
    blocks = np.maximum(1, -(-counts // BLOCK_ROWS))
    enough = int(np.ceil(share_needed(index, sample, k, recall) * n)) + 1
    plan = spark.sparkContext.broadcast((counts, blocks))

    @F.pandas_udf("int")
    def block_of(cell: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series((key.to_numpy() % plan.value[1][cell.to_numpy()]).astype(np.int32))

    spread = F.pmod(F.xxhash64("row"), F.lit(1 << 30))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        first = {"cell": group["cell"].iloc[0], "block": group["block"].iloc[0]}
        keys = {"keys": group["row"].to_numpy().astype("<i8").tobytes()}
        return pd.DataFrame([first | keys | packed(group["vec_id"].to_numpy(), matrix(group["v"]))])

    kept = "cell int, block int, keys binary, ids binary, rows binary"
    candidates = (
        indexed.withColumn("block", block_of("cell", spread))
        .groupBy("cell", "block")
        .applyInPandas(pack, kept)
    )

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, (counts, blocks) = shared.value, plan.value
        for batch in batches:
            for vec_id, v, row in zip(batch["vec_id"], batch["v"], batch["row"], strict=True):
                cells = np.array(index.traverse(unit(np.array([v]))[0], counts, enough), dtype=int)
                cell = np.repeat(cells, blocks[cells])
                block = np.concatenate([np.arange(blocks[c]) for c in cells])
                yield pd.DataFrame(
                    {"vec_id": vec_id, "v": [v] * len(cell), "row": row, "cell": cell, "block": block}
                )

    chunks = max(1, -(-n // (every * QUERY_ROWS)))
    visits = (
        rows.where(F.pmod("vec_id", F.lit(every)) == 0)
        .mapInPandas(visit, "vec_id long, v array<double>, row long, cell int, block int")
        .groupBy("cell", "block", F.pmod(spread, F.lit(chunks)).alias("chunk"))
        .applyInPandas(pack, kept)
        .select("cell", "block", *(F.col(c).alias(f"q_{c}") for c in ("keys", "ids", "rows")))
    )

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                (ids, data), (q_ids, q_data) = unpacked(row.ids, row.rows), unpacked(row.q_ids, row.q_rows)
                keys, q_keys = np.frombuffer(row.keys, "<i8"), np.frombuffer(row.q_keys, "<i8")
                near = unit(q_data) @ unit(data).T
                near[q_keys[:, None] == keys[None]] = -np.inf
                found = []
                least = np.partition(near, -k, axis=1)[:, -k] if len(ids) > k else None
                for at, query in enumerate(q_ids):
                    floor = -2.0 if least is None else max(-2.0, least[at] - SLACK)
                    close = np.flatnonzero(near[at] >= floor)
                    scores = cosines(q_data[at], data[close])
                    best = np.lexsort((ids[close], -scores))[:k]
                    found += [(q_keys[at], query, ids[close[b]], scores[b]) for b in best]
                yield pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"])

    scored = candidates.join(visits, ["cell", "block"]).mapInPandas(rank, schema)
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
