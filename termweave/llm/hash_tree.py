"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

Every shard draws ``-ln(u) / weight``, with ``u`` from a hash of the key and the shard's path of region, rack and own
number.  A rack's draw is the smallest of its shards', and a region's the smallest of its racks', which is again
a draw at the sum of their weights; a row descends to the region, rack and shard of the smallest draw.  A draw depends
on its own shard only.  So a changed weight moves rows only into or out of that shard, and one more shard, be it in an old
rack, a new rack or a new region, takes rows only into itself: nothing moves in or between other subtrees.

Rows are placed by key alone.  Null keys are one key; repeated rows share a shard and get
slots of their own; columns beyond those asked for are carried along, but for one of the result's name.  An empty table
gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import gapless_ranks, written

SEED = 101


@dataclass(frozen=True)
class Tree:
    """``weights[region][rack][shard]``; shards are numbered in that order. 0 takes no rows.

    A shard's path of places is what it draws by.  Layouts that change keep the places of what stays: remove by weight 0.
    """

    weights: tuple[tuple[tuple[float, ...], ...], ...]

    @property
    def shards(self) -> int:
        return len(self.paths)

    @property
    def paths(self) -> list[tuple[int, int, int]]:
        """The place ``(region, rack, shard)`` of each number."""
        return [
            (r, j, i)
            for r, region in enumerate(self.weights)
            for j, rack in enumerate(region)
            for i in range(len(rack))
        ]


def tree(shards: int, shards_per_rack: int = 5, racks_per_region: int = 4) -> Tree:
    """Equal shards, filled rack by rack and region by region."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    sizes = [min(shards_per_rack, shards - at) for at in range(0, shards, shards_per_rack)]
    racks = [(1.0,) * size for size in sizes]
    return Tree(
        tuple(
            tuple(racks[at : at + racks_per_region]) for at in range(0, len(racks), racks_per_region)
        )
    )


def _draw(key: Column, path: tuple[int, int, int], weight: float) -> Column:
    """A shard's draw; one without weight never has the smallest."""
    if weight <= 0:
        return F.lit(float("inf"))
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(SEED), *map(F.lit, path)), 11)
    return -F.ln((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))


def place(rows: DataFrame, key: str, layout: Tree, shard: str = "shard") -> DataFrame:
    """``rows`` with the number of the shard that ``key`` descends to."""
    k = F.col(key).cast("bigint")
    number = {path: at for at, path in enumerate(layout.paths)}
    if not number:
        raise ValueError("a tree needs a shard")

    def smallest(draws: list[Column]) -> Column:
        return F.array_min(F.array(*draws))

    regions = []
    for r, region in enumerate(layout.weights):
        racks = [
            smallest(
                [
                    F.struct(_draw(k, (r, j, i), weight).alias("draw"), F.lit(number[r, j, i]).alias("shard"))
                    for i, weight in enumerate(rack)
                ]
            )
            for j, rack in enumerate(region)
            if rack
        ]
        if racks:
            regions.append(smallest(racks))
    return rows.withColumn(shard, smallest(regions)["shard"].cast("int"))


def shard_documents(docs: DataFrame, layout: Tree, grown: Tree) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of ``(doc_id, text)``.

    ``size`` is the text's UTF-8 bytes plus 16; null and empty texts have none and crc 0.
    ``slot`` numbers the rows of a shard from 0, in an order that the rows alone decide.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = place(place(narrow, "doc_id", layout), "doc_id", grown, "grown_shard")
    placed = written(placed.withColumn("_row", F.monotonically_increasing_id()))
    order = ["doc_id", "size", "text_crc32"]
    ranked = gapless_ranks(placed, "shard", order, placed.count(), row="_row")
    return ranked.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("rank").alias("slot"), "grown_shard"
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """Save placed rows, a folder for each shard."""
    rows.write.partitionBy("shard").parquet(path)
