"""Pairs of sets that share a prefix token, told apart without exchanging them.

Pairs grow with the square of the records, what they are made of does not.  The sets of one side are dealt to cells, those of the other to
chunks, both by their size.  A cell's task reads all chunks of sizes that may be similar, so the tokens that two sets share
meet in one step, and a pair is made known once there.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.runtime import SMALL, shuffle_partitions, stored

# Prefix tokens of a cell, fewer where the shuffle is wider, and of a chunk.
CELL_TOKENS = 1 << 17
CHUNK_TOKENS = 1 << 18
# Meetings that are made and sorted at once, about.
MADE = 1 << 21
INT_NUMBERS = 2**31 - 1


def _pairs(lowest: float) -> Callable:
    """Rows of a cell ``(cell, rids, rsizes, rprefixes)`` and a chunk ``(sids, ssizes, sprefixes)`` to pairs ``(rid, sid)``."""
    most = MADE

    def pairs(batches):
        import numpy as np
        import pyarrow as pa

        def side(row, name):
            ids, sizes, prefixes = (row[f"{name}{part}"].values for part in ("ids", "sizes", "prefixes"))
            tokens = prefixes.flatten().to_numpy()
            record = np.repeat(np.arange(len(ids)), prefixes.value_lengths().to_numpy())
            return ids, sizes.to_numpy(), tokens, record

        cell = None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            for at in range(batch.num_rows):
                row = {name: column[at] for name, column in columns.items()}
                if cell != row["cell"].as_py():
                    cell = row["cell"].as_py()
                    rids, rsizes, tokens, record = side(row, "r")
                    order = np.argsort(tokens, kind="stable")
                    holders = record[order]
                    known, starts, counts = np.unique(tokens[order], return_index=True, return_counts=True)
                sids, ssizes, tokens, record = side(row, "s")
                place = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                hit = known[place] == tokens
                place, record = place[hit], record[hit]
                many = counts[place]
                made = np.cumsum(many)
                begin = 0
                while begin < len(place):
                    past = made[begin - 1] if begin else 0
                    end = max(begin + 1, int(np.searchsorted(made, past + most, side="right")))
                    end = int(np.searchsorted(record, record[end - 1], side="right"))  # whole sets
                    own = many[begin:end]
                    first = starts[place[begin:end]] - (made[begin:end] - own - past)
                    r = holders[np.repeat(first, own) + np.arange(made[end - 1] - past)]
                    s = np.repeat(record[begin:end], own)
                    near = (ssizes[s] >= rsizes[r] * lowest) & (rsizes[r] >= ssizes[s] * lowest)
                    met = np.sort(s[near] * len(rids) + r[near])
                    met = met[np.concatenate(([True], met[1:] != met[:-1]))] if len(met) else met
                    for cut in range(0, len(met), 1 << 17):
                        s, r = np.divmod(met[cut : cut + (1 << 17)], len(rids))
                        yield pa.RecordBatch.from_arrays([rids.take(pa.array(r)), sids.take(pa.array(s))], ["rid", "sid"])
                    begin = end
            del batch, columns

    return pairs


def scanned_candidates(sets: DataFrame, lowest: float, order: DataFrame) -> DataFrame:
    """``similarity.candidates`` of the prefixes of ``sets``: ``(rid, sid)``, once each.

    ``sets`` are in canonical ``order``, one of each side and id; ``lowest`` is the smallest similarity that counts.
    """
    spark = sets.sparkSession
    numbers = order.agg(F.count("*").alias("n"), F.count_if(F.col("freq") == 1).alias("alone")).first()
    size = F.size("tokens")
    length = (size - F.ceil(size * lowest) + 1).cast("int")
    # Tokens of one record, the first numbers, meet nothing.
    prefix = F.filter(F.slice("tokens", F.lit(1), length), lambda token: token >= numbers["alone"])
    prefix = prefix.cast("array<int>" if numbers["n"] <= INT_NUMBERS else "array<bigint>")
    # Sizes that may be similar are of the same or of neighbouring classes.
    width = max(0.05, 1e-6 - math.log(lowest))
    size_class = F.floor(F.ln(size) / width).cast("int")
    kept = sets.select("side", "id", size.alias("size"), size_class.alias("size_class"), prefix.alias("prefix"))
    kept = stored(kept.where(F.size("prefix") > 0), **SMALL)
    weights = kept.groupBy("side", "size_class").agg(F.sum(F.size("prefix")).alias("n")).collect()
    tasks = shuffle_partitions(sets)
    most = {"r": min(CELL_TOKENS, math.ceil(sum(w["n"] for w in weights if w["side"] == "r") / tasks)), "s": CHUNK_TOKENS}
    dealt, known = [], {"r": 0, "s": 0}
    for side, of_class, n in sorted(weights):
        parts = math.ceil(n / most[side])
        dealt.append((side, of_class, known[side], parts))
        known[side] += parts
    ids = sets.schema["id"].dataType.simpleString()
    if not known["r"] or not known["s"]:
        return spark.createDataFrame([], f"rid {ids}, sid {ids}")
    deal = spark.createDataFrame(dealt, "side string, size_class int, first int, parts int")
    cell = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("cell")
    placed = kept.join(F.broadcast(deal), ["side", "size_class"]).select(*kept.columns, cell)

    def rows(side: str) -> DataFrame:
        together = placed.where(F.col("side") == side).groupBy("cell", "size_class").agg(
            F.collect_list(F.struct("id", "size", "prefix")).alias("all")
        )
        return together.select(
            "cell",
            F.col("size_class").alias(f"{side}class"),
            F.col("all.id").alias(f"{side}ids"),
            F.col("all.size").alias(f"{side}sizes"),
            F.col("all.prefix").alias(f"{side}prefixes"),
        )

    small_groups = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}
    chunks = stored(rows("s").drop("cell"), **SMALL, **small_groups)
    cells = stored(rows("r"), **SMALL, **small_groups).repartitionById(known["r"], "cell")
    # Each task reads the rows of the one side, for its one row of the other.
    near = F.abs(F.col("sclass") - F.col("rclass")) <= 1
    met = chunks.coalesce(1).hint("shuffle_replicate_nl").join(cells, near).drop("sclass", "rclass")
    return met.mapInArrow(_pairs(lowest), f"rid {ids}, sid {ids}")
