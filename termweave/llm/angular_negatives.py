"""Hard negatives by integer inner product, with angular triangle filtering.

Every row keeps its angles to some reference directions.  Angles obey the triangle inequality: for a
reference at angles ``a`` and ``b`` from two rows, their own angle lies between ``|a - b|`` and the smaller of ``a + b``
and a full turn less that.  The references' intervals are intersected, turned into cosines, multiplied
by both norms and widened beyond any rounding, which bounds the score from both sides.  A pair gets
its exact integer score only if these bounds overlap a window that is asked for.

Rows lie in blocks by label, of which ``BUCKETS`` buckets are made, and nearest reference.  Anchors lie in at most some
``TILES`` tiles of the same kind, whose ranges of angles and norms and whose bucket say which blocks can matter: a block
meets the other tiles only in that summary.  First each anchor gets its positives, the best rows of its own label;
their scores make its windows.  Then blocks are searched for the best rows of other labels in
each window.  Tiles travel to blocks, which stay where they are.  References come from a bounded sample
(``SAMPLE`` rows), and the result does not depend on them.

Out stay rows with a null id, label or vector, a null or non-finite component, or another number of components
than most rows.  Rows that repeat an id are rows of their own.  Ties go to the smaller id.  A row of zeros scores
0 with all.  Products of a score with 100 must fit 63 bits.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termweave.llm.common import fraction, tidy, written
from termweave.llm.pivots import scores
from termweave.llm.vectors import finite, matrix, sampled

REFERENCES = 16
SAMPLE = 2_048
BLOCK_ROWS = 16_384
TILE_ROWS = 1_024
TILES = 1_024
BUCKETS = 16
SLICE = 2_048
NONE = -(1 << 62)

_BLOCK = (
    "block long, bucket int, rows binary, ids binary, labels binary, vectors binary, angles binary, norms binary,"
    " low array<double>, high array<double>, least double, most double, first_label long, last_label long"
)


def choose_references(sample: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors far apart in angle: each next one is farthest from those chosen."""
    norms = np.sqrt((sample**2).sum(axis=1))
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, sample.shape[1])
    chosen = [0]
    near = units @ units[0]
    while len(chosen) < min(n, len(units)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, units @ units[chosen[-1]])
    return units[chosen]


def angles_to(rows: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of rows to references; a row of zeros counts as at a right angle to all."""
    norms = np.sqrt((rows**2).sum(axis=1))
    cosines = (rows @ references.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def score_bounds(
    angles: np.ndarray, norms: np.ndarray, other_angles: np.ndarray, other_norms: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds on the scores of rows by others."""
    least = np.zeros((len(angles), len(other_angles)))
    most = np.full_like(least, np.pi)
    for a, b in zip(angles.T, other_angles.T, strict=True):
        np.maximum(least, np.abs(a[:, None] - b[None]), out=least)
        total = a[:, None] + b[None]
        np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
    both = norms[:, None] * other_norms[None]
    # An angle near 0 or a half turn is off by some 1e-8 of a turn, so a score by as much of the norms.
    room = 1e-6 * (1 + both)
    return np.cos(most) * both - room, np.cos(least) * both + room


def range_bounds(one: dict, two: dict) -> tuple[float, float]:
    """Bounds on all scores between two sets, by their ranges of angles and norms."""
    least = max(0.0, np.max(one["low"] - two["high"]), np.max(two["low"] - one["high"]))
    low, high = one["low"] + two["low"], one["high"] + two["high"]
    most = min(np.pi, np.min(np.where(high <= np.pi, high, np.where(low >= np.pi, 2 * np.pi - low, np.pi))))
    both = [one[a] * two[b] for a in ("least", "most") for b in ("least", "most")]
    room = 1e-6 * (1 + max(both))
    return min(np.cos(most) * b for b in both) - room, max(np.cos(least) * b for b in both) + room


class Packed:
    """The rows of a block or tile."""

    def __init__(self, row):
        self.rows, self.ids, self.labels = (
            np.frombuffer(data, "<i8") for data in (row.rows, row.ids, row.labels)
        )
        n = len(self.rows)
        self.vectors, self.angles = (
            np.frombuffer(data, "<f8").reshape(n, -1) for data in (row.vectors, row.angles)
        )
        self.norms = np.frombuffer(row.norms, "<f8")


def _pack(frame: pd.DataFrame, block: int) -> dict:
    # By id, so that of equal scores the first found is the one that counts.
    frame = frame.sort_values(["vec_id", "row"])
    angles, norms, labels = matrix(frame["angles"]), frame["norm"].to_numpy(), frame["label"].to_numpy()
    return {
        "block": block,
        "bucket": frame["bucket"].iloc[0],
        "rows": frame["row"].to_numpy().astype("<i8").tobytes(),
        "ids": frame["vec_id"].to_numpy().astype("<i8").tobytes(),
        "labels": labels.astype("<i8").tobytes(),
        "vectors": matrix(frame["v"]).astype("<f8").tobytes(),
        "angles": angles.astype("<f8").tobytes(),
        "norms": norms.astype("<f8").tobytes(),
        "low": angles.min(axis=0),
        "high": angles.max(axis=0),
        "least": norms.min(),
        "most": norms.max(),
        "first_label": labels.min(),
        "last_label": labels.max(),
    }


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in packs of some ``size``, those of a label bucket together, by their nearest reference.

    The rows of a bucket and reference are laid along a line, at places that hashes of the rows decide, and the line is cut.
    """
    counts = {
        (row["bucket"], row["home"]): row["n"]
        for row in rows.groupBy("bucket", "home").agg(F.count("*").alias("n")).collect()
    }  # at most BUCKETS * REFERENCES rows
    first, before, held = {}, {}, 0
    for bucket in sorted({bucket for bucket, _ in counts}):
        first[bucket], total = held, 0
        for home in range(REFERENCES):
            before[bucket, home] = total
            total += counts.get((bucket, home), 0)
        held += -(-total // size)
    cells = [(b, h) for b in range(BUCKETS) for h in range(REFERENCES)]
    cell = F.col("bucket") * REFERENCES + F.col("home")
    start, n = (
        F.get(F.array(*(F.lit(values.get(at, 0)).cast("bigint") for at in cells)), cell) for values in (before, counts)
    )
    base = F.get(F.array(*(F.lit(first.get(b, 0)) for b in range(BUCKETS))), F.col("bucket"))
    block = base + F.floor((start + F.floor(fraction("row") * n)) / size)

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_pack(frame, key[0])])

    dealt = rows.withColumn("block", block.cast("bigint"))
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


def positives_in(tile: Packed, block: Packed, k: int) -> pd.DataFrame:
    """Rows of a block that may be among the ``k`` best of the same label of a tile's anchors."""
    kth = np.full((len(tile.rows), k), NONE)
    out = []
    for at in range(0, len(block.rows), SLICE):
        part = slice(at, at + SLICE)
        _, high = score_bounds(tile.angles, tile.norms, block.angles[part], block.norms[part])
        possible = (
            (tile.labels[:, None] == block.labels[None, part])
            & (tile.rows[:, None] != block.rows[None, part])
            & (high >= kth[:, -1:])
        )
        anchors, others = np.flatnonzero(possible.any(axis=1)), np.flatnonzero(possible.any(axis=0))
        if not len(anchors):
            continue
        got = scores(tile.vectors[anchors], block.vectors[part][others])
        got[~possible[np.ix_(anchors, others)]] = NONE
        for who, where, score in _take(got, k):
            out.append((anchors[who], at + others[where], score))
            better = score > kth[anchors[who], -1]
            place = anchors[who[better]]
            kth[place, -1] = score[better]
            kth[place] = -np.sort(-kth[place], axis=1)
    return _found(tile, block, out)


def _found(tile: Packed, block: Packed, out: list) -> pd.DataFrame:
    none = [np.zeros(0, dtype=np.int64)]
    at, where, score = (np.concatenate(none + [part[i] for part in out]) for i in range(3))
    return pd.DataFrame(
        {"at": at, "anchor_id": tile.ids[at], "row": block.rows[where], "vec_id": block.ids[where], "score": score}
    )


def negatives_in(
    tile: Packed, low: np.ndarray, high: np.ndarray, block: Packed, k: int
) -> pd.DataFrame:
    """Rows of a block that may be among the ``k`` best of other labels in each window of a tile's anchors.

    ``low`` and ``high`` are the windows, anchors by places; one with ``low`` above ``high`` is empty.
    """
    floor = low.copy()
    out, window = [], []
    for at in range(0, len(block.rows), SLICE):
        part = slice(at, at + SLICE)
        least, most = score_bounds(tile.angles, tile.norms, block.angles[part], block.norms[part])
        other = tile.labels[:, None] != block.labels[None, part]
        possible = np.zeros(other.shape, dtype=bool)
        for w in range(low.shape[1]):
            some = low[:, w] <= high[:, w]
            possible |= some[:, None] & (most >= floor[:, w, None]) & (least <= high[:, w, None])
        possible &= other
        anchors, others = np.flatnonzero(possible.any(axis=1)), np.flatnonzero(possible.any(axis=0))
        if not len(anchors):
            continue
        got = scores(tile.vectors[anchors], block.vectors[part][others])
        got[~possible[np.ix_(anchors, others)]] = NONE
        for w in range(low.shape[1]):
            inside = (got >= floor[anchors, w, None]) & (got <= high[anchors, w, None])
            found = np.where(inside, got, NONE)
            for step, (who, where, score) in enumerate(_take(found, k)):
                out.append((anchors[who], at + others[where], score))
                window.append(np.full(len(who), w))
                if step == k - 1:  # nothing below its k-th best counts any more
                    floor[anchors[who], w] = np.maximum(floor[anchors[who], w], score)
    frame = _found(tile, block, out)
    return frame.assign(window=np.concatenate([np.zeros(0, dtype=np.int64), *window]))


def _integers(scale: float) -> Column:
    return F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double"))


def mine(
    vectors: DataFrame,
    scale: float = 256.0,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Negatives of ``(vec_id, embedding, label)`` for the rows whose id ``every`` divides.

    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each of an anchor's best
    ``positives`` rows of the same label, the best ``negatives`` rows of other labels whose score is between ``low`` and ``high``
    hundredths of the positive's.
    """
    spark = vectors.sparkSession
    result = (
        "anchor_id long, positive_id long, rank int, negative_id long,"
        " positive_score long, negative_score long"
    )
    fine = finite(vectors.where("label IS NOT NULL"), "label")
    fine = fine.select("vec_id", F.col("label").cast("bigint").alias("label"), _integers(scale).alias("v"))
    # Numbered as written, so that rows that repeat an id stay apart.
    rows = written(fine.where("vec_id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()))
    is_anchor = F.pmod("vec_id", F.lit(every)) == 0
    n, n_anchors = rows.select(F.count("*"), F.count_if(is_anchor)).first()
    if not n_anchors:
        return spark.createDataFrame([], result)
    # At most REFERENCES vectors.
    shared = spark.sparkContext.broadcast(choose_references(sampled(rows, n, SAMPLE), REFERENCES))

    @tidy
    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                data = matrix(frame["v"])
                found = angles_to(data, shared.value)
                yield frame.assign(
                    angles=list(found),
                    norm=np.sqrt((data**2).sum(axis=1)),
                    home=found.argmin(axis=1).astype(np.int32),
                )

    kinds = (
        "vec_id long, label long, v array<double>, row long, bucket int,"
        " angles array<double>, norm double, home int"
    )
    bucket = F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int")
    known = written(rows.withColumn("bucket", bucket).mapInPandas(measure, kinds))
    blocks = _blocks(known, BLOCK_ROWS)
    tiles = _blocks(known.where(is_anchor), max(TILE_ROWS, -(-n_anchors // TILES)))
    # At most TILES + BUCKETS rows of a few hundred bytes, whatever the number of anchors.
    facts = ("block", "bucket", "low", "high", "least", "most", "first_label", "last_label")
    summary = [
        row.asDict() | {"low": np.array(row["low"]), "high": np.array(row["high"])}
        for row in tiles.select(*facts).collect()
    ]

    def met(wanted) -> DataFrame:
        """``(block, tile)`` of all pairs that ``wanted`` lets meet, by their summaries."""

        def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                pairs = []
                for row in frame.to_dict("records"):
                    row |= {"low": np.array(row["low"]), "high": np.array(row["high"])}
                    pairs += [(row["block"], tile["block"]) for tile in summary if wanted(tile, row)]
                yield pd.DataFrame(pairs, columns=["block", "tile"], dtype="int64")

        return blocks.select(*facts).mapInPandas(choose, "block long, tile long")

    def together(pairs: DataFrame, side: DataFrame) -> DataFrame:
        sent = pairs.join(side.withColumnRenamed("block", "tile"), "tile")
        payload = ("rows", "ids", "labels", "vectors", "angles", "norms")
        named = [F.struct(*payload).alias("a"), *(c for c in ("block", "tile", "low_scores", "high_scores") if c in sent.columns)]
        return sent.select(*named).join(blocks.select("block", F.struct(*payload).alias("b")), "block")

    def sides(frame: pd.DataFrame) -> Iterator[tuple]:
        for row in frame.itertuples(index=False):
            yield row, *(Packed(pd.Series(side)) for side in (row.a, row.b))

    @tidy
    def find_positives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, tile, block in sides(frame):
                yield positives_in(tile, block, positives).assign(tile=row.tile)

    def same_bucket(tile: dict, block: dict) -> bool:
        return tile["bucket"] == block["bucket"]

    hit = "at long, anchor_id long, row long, vec_id long, score long"
    pairs = together(met(same_bucket), tiles).mapInPandas(find_positives, f"{hit}, tile long")
    best = W.partitionBy("tile", "at").orderBy(F.desc("score"), "vec_id", "row")
    asked = written(
        pairs.withColumn("window", F.row_number().over(best) - 1)
        .where(F.col("window") < positives)
        .select("tile", "at", "anchor_id", "window", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )

    def windows(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # A tile's positives: at most some of them per row.
        lows = np.full((frame["at"].max() + 1, positives), 1, dtype="<i8")
        highs = np.zeros_like(lows)
        score = frame["positive_score"].to_numpy()
        lows[frame["at"], frame["window"]] = -(-low * score // 100)
        highs[frame["at"], frame["window"]] = high * score // 100
        some = lows <= highs
        return pd.DataFrame(
            [
                {
                    "tile": key[0],
                    "low_scores": lows.tobytes(),
                    "high_scores": highs.tobytes(),
                    "lowest": lows[some].min(initial=1 << 62),
                    "highest": highs[some].max(initial=NONE),
                }
            ]
        )

    ranges = "tile long, low_scores binary, high_scores binary, lowest long, highest long"
    armed = written(asked.groupBy("tile").applyInPandas(windows, ranges))
    reach = {row["tile"]: (row["lowest"], row["highest"]) for row in armed.select("tile", "lowest", "highest").collect()}

    def reachable(tile: dict, block: dict) -> bool:
        lowest, highest = reach.get(tile["block"], (1, 0))
        one_label = tile["first_label"] == tile["last_label"] == block["first_label"] == block["last_label"]
        if lowest > highest or one_label:
            return False
        least, most = range_bounds(tile, block)
        return most >= lowest and least <= highest

    @tidy
    def find_negatives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, tile, block in sides(frame):
                bounds = []
                for data, empty in ((row.low_scores, 1), (row.high_scores, 0)):
                    given = np.frombuffer(data, "<i8").reshape(-1, positives)
                    whole = np.full((len(tile.rows), positives), empty, dtype=np.int64)
                    whole[: len(given)] = given
                    bounds.append(whole)
                yield negatives_in(tile, *bounds, block, negatives).assign(tile=row.tile)

    side = tiles.join(armed.withColumnRenamed("tile", "block"), "block")
    found = together(met(reachable), side).mapInPandas(find_negatives, f"{hit}, window long, tile long")
    order = W.partitionBy("tile", "at", "window").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.drop("anchor_id").join(asked, ["tile", "at", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
