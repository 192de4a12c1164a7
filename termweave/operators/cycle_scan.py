"""Counts of cycles of five vertices without exchanging their paths.

Vertices are numbered by their rank.  A task has a range of starts and reads all edges three times: for the neighbours of its starts, for
theirs, and for the edges that join the halves ``start, a, b`` and ``c, d, start``.  It holds the halves of two edges of its starts only; a start has at most
as many as there are edges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.operators.pair_scan import ranges
from termweave.operators.rows import in_order
from termweave.operators.skew import lookup_join
from termweave.runtime import SMALL, shuffle_partitions, stored

# Halves of two edges, of either direction, that a task holds, about.
CELL_HALVES = 3 << 19
# Edges of a row that all tasks read.
ROW_EDGES = 1 << 16
# Paths of three edges that are made at once, about.
MADE = 1 << 20
PACKED = "out boolean, n int, first bigint, last bigint, bytes int, columns int, numbers binary"


def _packer() -> Callable:
    """Edges ``(out, key, next, n)`` of one direction a partition, in order of the key, to rows ``PACKED``."""
    most = ROW_EDGES

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        def row(way, edges):
            columns = edges if (edges[2] != 1).any() else edges[:2]
            size = 4 if max(column.max() for column in columns) < 1 << 31 else 8
            packed = pa.Codec("zstd").compress(np.concatenate(columns).astype(f"<i{size}"), asbytes=True)
            values = [pa.array([way]), pa.array([len(edges[0])], pa.int32()), *(pa.array([edges[0][end]]) for end in (0, -1))]
            values += [pa.array([x], pa.int32()) for x in (size, len(columns))]
            values.append(pa.array([packed], pa.binary()))
            return pa.RecordBatch.from_arrays(values, ["out", "n", "first", "last", "bytes", "columns", "numbers"])

        waiting = {True: [], False: []}
        for batch in batches:
            columns = [batch.column(name).to_numpy() for name in ("key", "next", "n")]
            out = batch.column("out").to_numpy(zero_copy_only=False)
            for way, parts in waiting.items():
                parts.append([column[out == way] for column in columns])
                if sum(len(part[0]) for part in parts) >= most:
                    edges = [np.concatenate(column) for column in zip(*parts)]
                    for at in range(0, len(edges[0]), most):
                        yield row(way, [column[at : at + most] for column in edges])
                    parts.clear()
        for way, parts in waiting.items():
            edges = [np.concatenate(column) for column in zip(*parts)]
            if edges and len(edges[0]):
                yield row(way, edges)

    return pack


def _counter(cells: list[tuple[int, int]], n_vertices: int) -> Callable:
    """All rows ``PACKED``, with ``at`` for each of a cell's three readings, to the number of cycles ``(n)`` of its starts, as text."""
    most = MADE

    def count(batches):
        import numpy as np
        import pyarrow as pa

        def product(a, b):
            if len(a) and int(a.max()) * int(b.max()) >= 1 << 63:
                return a.astype(object) * b.astype(object)
            return a * b

        def summed(a):
            if len(a) and a.dtype != object and int(a.max()) * len(a) >= 1 << 63:
                a = a.astype(object)
            return int(a.sum()) if len(a) else 0

        def marked(vertices):
            member = np.zeros(n_vertices, bool)
            member[vertices] = True
            return member

        def joined(parts):
            return [np.concatenate(column) for column in zip(*parts)] if parts else [np.empty(0, "i8")] * 3

        def pieces(many):
            """Slices of rows that have ``many`` partners each, with the places of rows and partners."""
            made = np.cumsum(many)
            begin = 0
            while begin < len(many):
                past = made[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(made, past + most, side="right")))
                own = many[begin:end]
                nth = np.arange(made[end - 1] - past) - np.repeat(made[begin:end] - own - past, own)
                yield np.repeat(np.arange(begin, end), own), nth
                begin = end

        def halves(first, second):
            """``(start, middle, end, n)`` of edges of starts and edges of their neighbours, below the start."""
            order = np.argsort(second[0], kind="stable")
            keys, ends, n = (column[order] for column in second)
            left = np.searchsorted(keys, first[1])
            many = np.searchsorted(keys, first[1], side="right") - left
            found = []
            for row, nth in pieces(many):
                at = left[row] + nth
                below = ends[at] < first[0][row]
                row, at = row[below], at[below]
                found.append((first[0][row], first[1][row], ends[at], product(first[2][row], n[at])))
            return [np.concatenate(column) for column in zip(*found)] if found else [np.empty(0, "i8")] * 4

        total, phase, low, high = 0, -1, 0, 0
        kept = {True: [], False: []}
        wanted, firsts = {}, {}
        forward = backward = to_ends = keys = key_starts = key_counts = maybe = None

        def begin(at):
            """What a reading needs of the one before it."""
            nonlocal phase, low, high, kept, wanted, forward, backward, to_ends, keys, key_starts, key_counts, maybe
            low, high = cells[at // 3]
            if at % 3 != phase + 1:
                raise RuntimeError("edges were not read in the order of their readings")
            phase = at % 3
            read = {way: joined(kept[way]) for way in kept}
            kept = {True: [], False: []}
            if phase == 1:
                for way in (True, False):
                    firsts[way] = read[way]
                    wanted[way] = marked(read[way][1])
            if phase == 2:
                forward, backward = (halves(firsts[way], read[way]) for way in (True, False))
                order = np.argsort(forward[2], kind="stable")
                forward = [column[order] for column in forward]
                wanted, to_ends = {True: marked(forward[2])}, marked(backward[2])
                pair = (backward[0] - low) * n_vertices + backward[2]
                order = np.argsort(pair, kind="stable")
                backward = [column[order] for column in backward]
                keys, key_starts, key_counts = np.unique(pair[order], return_index=True, return_counts=True)
                maybe = np.zeros(1 << 22, bool)
                maybe[keys * 0x9E3779B1 >> 9 & len(maybe) - 1] = True

        def closed(source, target, n):
            """Cycles through edges between ends of halves."""
            found = 0
            left = np.searchsorted(forward[2], source)
            for row, nth in pieces(np.searchsorted(forward[2], source, side="right") - left):
                at = left[row] + nth
                pair = (forward[0][at] - low) * n_vertices + target[row]
                likely = maybe[pair * 0x9E3779B1 >> 9 & len(maybe) - 1] & (forward[1][at] != target[row])
                row, at, pair = row[likely], at[likely], pair[likely]
                place = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
                met = keys[place] == pair
                row, at, place = row[met], at[met], place[met]
                for nth_row, nth_back in pieces(key_counts[place]):
                    back = key_starts[place[nth_row]] + nth_back
                    own, edge = at[nth_row], row[nth_row]
                    apart = (backward[1][back] != forward[1][own]) & (backward[1][back] != forward[2][own])
                    back, own, edge = back[apart], own[apart], edge[apart]
                    found += summed(product(product(forward[3][own], n[edge]), backward[3][back]))
            return found

        last = None
        for batch in batches:
            rows = {name: batch.column(name) for name in batch.schema.names}
            for row in range(batch.num_rows):
                at = rows["at"][row].as_py()
                if at != last:
                    begin(at)
                    last = at
                way = rows["out"][row].as_py()
                if phase == 2 and not way:
                    continue
                first, last_key, n, size, columns = (rows[x][row].as_py() for x in ("first", "last", "n", "bytes", "columns"))
                if phase == 0 and (last_key < low or first >= high):
                    continue
                raw = pa.Codec("zstd").decompress(rows["numbers"][row].as_buffer(), columns * size * n)
                numbers = np.frombuffer(raw, f"<i{size}").reshape(columns, n)
                key, near = numbers[:2]
                if phase == 0:
                    own = (key >= low) & (key < high) & (near < key)
                elif phase == 1:
                    own = wanted[way][key]
                else:
                    own = wanted[True][key] & to_ends[near]
                if own.any():
                    found = [column[own].astype("i8") for column in numbers]
                    if columns == 2:
                        found.append(np.ones(len(found[0]), "i8"))
                    if phase == 2:
                        total += closed(*found)
                    else:
                        kept[way].append(found)
        yield pa.RecordBatch.from_arrays([pa.array([str(total)])], ["n"])

    return count


def count_five_cycles(known: DataFrame, degrees: DataFrame) -> DataFrame:
    """``(n_cycles)`` of the edges ``(src, dst, n)`` whose ends are among ``(vertex, degree, out)``."""
    spark = known.sparkSession
    ranks = stored(in_order(degrees, "rank", "degree", "vertex"), **SMALL)
    for side in ("src", "dst"):
        rank = ranks.select(F.col("vertex").alias(side), F.col("rank").alias(f"{side}_rank"), "degree")
        known = lookup_join(known, rank, key=side, weight="degree").drop("degree", side)
    known = stored(known, **SMALL)
    ways = [
        known.select(F.lit(out).alias("out"), F.col(f"{key}_rank").alias("key"), F.col(f"{near}_rank").alias("next"), "n")
        for out, key, near in ((True, "src", "dst"), (False, "dst", "src"))
    ]
    edges = ways[0].unionByName(ways[1]).repartitionByRange("key").sortWithinPartitions("key", "next")
    rows = stored(edges.mapInArrow(_packer(), PACKED), **{"parquet.block.size": str(16 << 20)})
    # Paths below a start, as if its neighbours were drawn by their degrees: decides the size of tasks only.
    all_of = ranks.agg(F.count("*").alias("n"), F.sum("degree").alias("degree"), F.sum(F.col("degree") ** 2).alias("squares")).first()
    below = (F.col("rank") + 1) / all_of["n"]
    expected = F.col("degree") * below**2 * (all_of["squares"] / all_of["degree"] / 2)
    work = ranks.select(F.col("rank").alias("id"), (expected / CELL_HALVES).alias("work"))
    cells = [(low, high) for low, high, _ in ranges(work, shuffle_partitions(known))]
    tasks = spark.range(0, 3 * len(cells), 1, len(cells)).withColumnRenamed("id", "at")
    # For each of a task's three rows all rows of the other side.
    met = tasks.hint("shuffle_replicate_nl").crossJoin(rows.coalesce(1))
    counted = met.mapInArrow(_counter(cells, all_of["n"]), "n string")
    total = F.coalesce(F.sum(F.col("n").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
    return counted.agg(total.alias("n_cycles"))
