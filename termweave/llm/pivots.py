"""Exact top-k by integer inner product, with pivot-table elimination.

A table holds each vector's distances to some pivots; it is computed once and lies beside the vectors.  By the triangle
inequality the largest difference of two vectors' distances to a pivot is a lower bound on their own distance ``d``, and
``q . x = (|q|^2 + |x|^2 - d^2) / 2`` turns it into an upper bound on the score.  Candidates are met in
the order of that bound, until it falls below the k-th best score: no later one can enter.

Vectors lie in blocks, and queries in at most some ``TILES`` tiles, both ordered by their nearest pivot.  A first round gives every query the
k-th best score of the block that the bound of tile against block ranks highest.  A second one sends tiles to those other blocks that
this bound does not rule out; inside, candidates are sorted by their best bound for the
tile's queries and evaluated slice by slice, and a query stops at the slice whose bounds are all
below its k-th best.  Pivots come from a bounded sample (``SAMPLE`` rows); nothing else is sampled, and the
result does not depend on them.

Scores are whole numbers of up to 63 bits and exact: in doubles below 2^53, else in 64-bit integers.
Out stay rows with a null id, and vectors as ``vectors.finite`` says.  Rows that repeat an id are rows of their own, each a
candidate of the others and, where the id is a query's, a query.  Ties go to the
smaller id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termweave.llm.common import fraction, tidy, written
from termweave.llm.vectors import finite, matrix, sampled

PIVOTS = 32
SAMPLE = 2_048
BLOCK_ROWS = 8_192
QUERY_ROWS = 512
TILES = 1_024
SLICE = 512
NONE = -(1 << 62)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far-apart rows: each next one is farthest from those chosen."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table."""
    return np.sqrt(np.stack([((rows - p) ** 2).sum(axis=1) for p in pivots], axis=1))


def upper_bounds(q_table, q_squares, table, squares) -> np.ndarray:
    """Upper bounds on scores, queries by candidates, a little high to cover rounding."""
    low = np.zeros((len(q_table), len(table)))
    step = np.empty_like(low)
    for p in range(table.shape[1]):
        np.subtract(q_table[:, p, None], table[None, :, p], out=step)
        np.abs(step, out=step)
        np.maximum(low, step, out=low)
    np.multiply(low, low, out=low)
    np.subtract(squares[None], low, out=low)
    low += q_squares[:, None]
    low *= 0.5
    return low + 1e-6 * (1 + q_squares[:, None] + squares[None])


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    most = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    if most * most * queries.shape[1] < 1 << 53:
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T


class Packed:
    """The rows of a block or tile."""

    def __init__(self, row):
        self.rows, self.ids = np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["ids"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(self.ids), -1)
        self.table = np.frombuffer(row["table"], "<f8").reshape(len(self.ids), -1)
        self.squares = (self.vectors**2).sum(axis=1)


_PAYLOAD = ("rows", "ids", "vectors", "table")
_BLOCK = (
    "block long, rows binary, ids binary, vectors binary, table binary,"
    " low array<double>, high array<double>, most double"
)


def _pack(frame: pd.DataFrame, block: int) -> dict:
    # By id, so that of equal scores the first found is the one that counts.
    frame = frame.sort_values(["vec_id", "row"])
    data, table = matrix(frame["v"]), matrix(frame["distances"])
    return {
        "block": block,
        "rows": frame["row"].to_numpy().astype("<i8").tobytes(),
        "ids": frame["vec_id"].to_numpy().astype("<i8").tobytes(),
        "vectors": data.astype("<f8").tobytes(),
        "table": table.astype("<f8").tobytes(),
        "low": table.min(axis=0),
        "high": table.max(axis=0),
        "most": (data**2).sum(axis=1).max(),
    }


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in packs of some ``size``, laid along a line by their nearest pivot, at places that a hash decides."""
    counts = {
        row["home"]: row["n"] for row in rows.groupBy("home").agg(F.count("*").alias("n")).collect()
    }  # at most PIVOTS rows
    place, total = F.lit(0), 0
    for home, n in sorted(counts.items()):
        inside = F.lit(total) + F.floor(fraction("row") * n)
        place = F.when(F.col("home") == home, inside).otherwise(place)
        total += n

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_pack(frame, key[0])])

    dealt = rows.withColumn("block", F.floor(place / size).cast("bigint"))
    return written(dealt.groupBy("block").applyInPandas(pack, _BLOCK))


def _take(found: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Up to ``k`` times the best that is left of each row, as rows, places and scores; uses up ``found``."""
    every = np.arange(len(found))
    for _ in range(k if found.shape[1] else 0):
        at = found.argmax(axis=1)
        best = found[every, at]
        hit = np.flatnonzero(best > NONE)
        if not len(hit):
            return
        yield hit, at[hit], best[hit]
        found[every, at] = NONE


def best_in_block(tile: Packed, known: np.ndarray, block: Packed, k: int) -> pd.DataFrame:
    """Those candidates of a block that may be among the best ``k`` of a tile's queries.

    ``known`` is a score that k candidates of the query are known to reach.
    """
    bounds = upper_bounds(tile.table, tile.squares, block.table, block.squares)
    order = np.argsort(-bounds.max(axis=0), kind="stable")
    cuts = range(0, len(order), SLICE)
    slice_bounds = np.stack([bounds[:, order[at : at + SLICE]].max(axis=1) for at in cuts], axis=1)
    # The largest bound of this slice and all later ones.
    slice_bounds = np.maximum.accumulate(slice_bounds[:, ::-1], axis=1)[:, ::-1]
    best = np.full((len(tile.ids), k), NONE)
    best[:, -1] = known  # a floor that is no candidate
    out = [(np.zeros(0, dtype=np.int64),) * 3]
    for step, at in enumerate(cuts):
        going = np.flatnonzero(slice_bounds[:, step] >= best[:, -1])
        if not len(going):
            break
        part = np.sort(order[at : at + SLICE])
        got = scores(tile.vectors[going], block.vectors[part])
        got[tile.rows[going][:, None] == block.rows[part][None]] = NONE
        got[got < best[going, -1:]] = NONE
        held = []
        for who, where, score in _take(got, k):
            out.append((going[who], part[where], score))
            held.append((who, score))
        fresh = np.full((len(going), k), NONE)
        for column, (who, score) in enumerate(held):
            fresh[who, column] = score
        both = np.concatenate([best[going], fresh], axis=1)
        best[going] = np.maximum(-np.sort(-both, axis=1)[:, :k], best[going, -1:])
    at, where, score = (np.concatenate(parts) for parts in zip(*out, strict=True))
    kept = score >= best[at, -1]
    at, where, score = at[kept], where[kept], score[kept]
    return pd.DataFrame(
        {"at": at, "query_id": tile.ids[at], "row": block.rows[where], "vec_id": block.ids[where], "score": score}
    )


def top_k(vectors: DataFrame, scale: float = 64.0, every: int = 20, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows whose id ``every`` divides."""
    spark = vectors.sparkSession
    whole = F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double"))
    fine = finite(vectors).where("vec_id IS NOT NULL").select("vec_id", whole.alias("v"))
    # Numbered as written, so that rows that repeat an id stay apart.
    rows = written(fine.withColumn("row", F.monotonically_increasing_id()))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, n_queries = rows.select(F.count("*"), F.count_if(is_query)).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # At most PIVOTS vectors.
    shared = spark.sparkContext.broadcast(choose_pivots(sampled(rows, n, SAMPLE), PIVOTS))

    @tidy
    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                table = distances(matrix(frame["v"]), shared.value)
                yield frame.assign(distances=list(table), home=table.argmin(axis=1).astype(np.int32))

    known = written(
        rows.mapInPandas(measure, "vec_id long, v array<double>, row long, distances array<double>, home int")
    )
    blocks = _blocks(known, BLOCK_ROWS)
    tiles = _blocks(known.where(is_query), max(QUERY_ROWS, -(-n_queries // TILES)))
    # At most TILES + 1 rows of a few hundred bytes, whatever the number of queries.
    summary = [
        (row["block"], np.array(row["low"]), np.array(row["high"]), row["most"])
        for row in tiles.select("block", "low", "high", "most").collect()
    ]

    @tidy
    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The largest score that a block and a tile may have, by their ranges of distances."""
        for frame in frames:
            out = []
            for block, low, high, most in frame.itertuples(index=False):
                for tile, t_low, t_high, t_most in summary:
                    gap = max(0.0, np.max(low - t_high), np.max(t_low - high))
                    best = (most + t_most - gap * gap) / 2 + 1e-6 * (1 + most + t_most)
                    out.append((block, tile, best))
            yield pd.DataFrame(out, columns=["block", "tile", "bound"])

    pairs = written(
        blocks.select("block", "low", "high", "most").mapInPandas(bound, "block long, tile long, bound double")
    )

    @tidy
    def evaluate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                tile, block = Packed(row.a), Packed(row.b)
                floors = np.full(len(tile.ids), NONE)
                if row.floors is not None:
                    given = np.frombuffer(row.floors, "<i8")
                    floors[: len(given)] = given
                yield best_in_block(tile, floors, block, k).assign(tile=row.tile)

    def found(met: DataFrame) -> DataFrame:
        """Hits of pairs ``(block, tile, floors)``.  Tiles travel; blocks are moved once."""
        side = tiles.select(F.col("block").alias("tile"), F.struct(*_PAYLOAD).alias("a"))
        sent = met.join(side, "tile").select("tile", "block", "floors", "a")
        both = sent.join(blocks.select("block", F.struct(*_PAYLOAD).alias("b")), "block")
        return both.mapInPandas(
            evaluate, "at long, query_id long, row long, vec_id long, score long, tile long"
        )

    none = F.lit(None).cast("binary").alias("floors")
    first = pairs.groupBy("tile").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    opened = written(found(first.select("block", "tile", none)))

    def floor_of(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # A tile's hits in one block: at most k and its slices' ties a query.
        ranked = frame.sort_values("score", ascending=False).groupby("at")["score"].nth(k - 1)
        at = frame["at"][ranked.index].to_numpy()
        floors = np.full(int(frame["at"].max()) + 1, NONE, dtype="<i8")
        floors[at] = ranked.to_numpy()
        return pd.DataFrame([{"tile": key[0], "floors": floors.tobytes(), "least": floors.min(), "held": len(floors)}])

    floors = opened.groupBy("tile").applyInPandas(floor_of, "tile long, floors binary, least long, held int")
    sizes = tiles.select(F.col("block").alias("tile"), (F.octet_length("rows") / 8).alias("n"))
    least = F.when(F.col("held") == F.col("n"), F.col("least")).otherwise(F.lit(NONE))
    armed = written(sizes.join(floors, "tile", "left").select("tile", "floors", least.alias("least")))
    rest = pairs.join(first.withColumnRenamed("block", "opening"), "tile").where("block != opening")
    met = rest.join(armed, "tile").where(F.col("bound") >= F.col("least"))
    hits = opened.unionByName(found(met.select("block", "tile", "floors")))
    order = W.partitionBy("tile", "at").orderBy(F.desc("score"), "vec_id", "row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
