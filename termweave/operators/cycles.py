"""Simple paths and simple cycles of a directed graph given as edges ``(src, dst)``.

Parallel edges are collapsed to one edge with a multiplicity ``n`` before anything is
joined, and multiply into every result.  Self-loops never lie on a simple path.

A cycle is found from one of its vertices only: the one that ranks highest by
(degree, id).  It is put together from two halves that leave that vertex forwards and
backwards and meet, so a cycle of ``k`` edges costs paths of ``k / 2``.  Ranking by
degree is what keeps hubs cheap: a path goes *through* a hub only if it started at a
vertex of even higher degree, of which there are few.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.operators.cycle_scan import count_five_cycles
from termweave.operators.skew import SPLIT_CELL_ROWS, balanced_join, key_sizes, lookup_join, result_tasks
from termweave.runtime import shuffle_partitions, stored

# Rounds of removing vertices that no cycle can pass.
TRIM_ROUNDS = 16
# Tasks that count half cycles, per partition of a shuffle: halves outnumber the edges.
SPREAD = 4
# Paths of two edges up to which halves of three edges are exchanged.
SENT_PATHS = 1 << 22


def vertices(edges: DataFrame) -> DataFrame:
    """``(vertex)``: every end point once."""
    return edges.select(F.explode(F.array("src", "dst")).alias("vertex")).distinct()


def weighted_edges(edges: DataFrame) -> DataFrame:
    """``(src, dst, n)``: proper edges with their number of parallel copies."""
    proper = edges.where(F.col("src") != F.col("dst"))
    return proper.groupBy("src", "dst").agg(F.count("*").alias("n"))


def simple_paths(edges: DataFrame, k: int) -> DataFrame:
    """``(path, n)``: paths of ``k`` different vertices, ``n`` choices of parallel edges each."""
    if k < 2:
        raise ValueError("a path needs k >= 2 vertices")
    known = stored(weighted_edges(edges))
    steps = known.select(
        F.col("src").alias("end"), F.col("dst").alias("next"), F.col("n").alias("step_n")
    )
    paths = known.select(F.array("src", "dst").alias("path"), F.col("dst").alias("end"), "n")
    for extension in range(k - 2):
        if extension:  # the join reads its input twice
            paths = stored(paths)
        paths = (
            balanced_join(paths, steps, ["end"])
            .where(~F.array_contains("path", F.col("next")))
            .select(
                F.array_append("path", F.col("next")).alias("path"),
                F.col("next").alias("end"),
                (F.col("n") * F.col("step_n")).alias("n"),
            )
        )
    return paths.select("path", "n")


def _degrees(known: DataFrame) -> DataFrame:
    """``(vertex, degree, out)``: number of different edges at each vertex, and of those that leave it."""
    ends = known.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("vertex"), F.lit(1).alias("out")),
                F.struct(F.col("dst").alias("vertex"), F.lit(0).alias("out")),
            )
        ).alias("end")
    ).select("end.*")
    return stored(ends.groupBy("vertex").agg(F.count("*").alias("degree"), F.sum("out").alias("out")))


def _with_degrees(known: DataFrame, degrees: DataFrame) -> DataFrame:
    """Edges both of whose ends have a degree, with ``src_degree`` and ``dst_degree``."""
    for side in ("src", "dst"):
        degree = degrees.select(F.col("vertex").alias(side), F.col("degree").alias(f"{side}_degree"))
        known = lookup_join(known, degree, key=side, weight=f"{side}_degree")
    return known.select("src", "src_degree", "dst", "dst_degree", "n")


def ranked_edges(edges: DataFrame, rounds: int = TRIM_ROUNDS) -> DataFrame:
    """``(src, src_degree, dst, dst_degree, n)`` of edges whose ends could lie on a cycle.

    A vertex without incoming or without outgoing edge is on no cycle, so it goes with its edges, and then
    those that were left without such an edge thereby, until all have both.  That takes as many rounds as the longest chain that
    leads nowhere has vertices; after ``rounds`` the rest of it stays, which costs some paths and changes no result.
    """
    return _with_degrees(*_trimmed(edges, rounds))


def _trimmed(edges: DataFrame, rounds: int = TRIM_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Proper edges, and the degrees of their ends, of both of which ``ranked_edges`` are made.  Stored tables."""
    known = stored(weighted_edges(edges))
    degrees = _degrees(known)
    alive = (F.col("out") > 0) & (F.col("out") < F.col("degree"))
    for _ in range(rounds):
        if degrees.where(~alive).isEmpty():
            break
        known = stored(_with_degrees(known, degrees.where(alive)).select("src", "dst", "n"))
        degrees = _degrees(known)
    return known, degrees


def _lower(a: str, b: str) -> Column:
    """Whether vertex ``a`` ranks below vertex ``b``."""
    return F.struct(f"{a}_degree", a) < F.struct(f"{b}_degree", b)


def _half_cycles(ranked: DataFrame, length: int) -> tuple[DataFrame, int]:
    """``(start, start_degree, end, inner, n)``: paths of ``length`` edges that stay below their start.

    And the number of tasks that make them, or are to work on them: at most about ``TASK_RESULT_ROWS`` of them each.
    """
    tasks = shuffle_partitions(ranked)
    paths = ranked.where(_lower("dst", "src")).select(
        F.col("src").alias("start"),
        F.col("src_degree").alias("start_degree"),
        F.col("dst").alias("end"),
        F.array().cast("array<bigint>").alias("inner"),
        "n",
    )
    steps = ranked.select(
        F.col("src").alias("end"),
        F.col("dst").alias("next"),
        F.col("dst_degree").alias("next_degree"),
        F.col("n").alias("step_n"),
    )
    for extension in range(length - 1):
        if extension:  # the join reads its input twice
            paths = stored(paths)
        sizes = key_sizes(paths, steps, ["end"])
        tasks = result_tasks(sizes)
        paths = (
            balanced_join(paths, steps, ["end"], sizes=sizes)
            .where(_lower("next", "start") & ~F.array_contains("inner", F.col("next")))
            .select(
                "start",
                "start_degree",
                F.col("next").alias("end"),
                F.array_append("inner", F.col("end")).alias("inner"),
                (F.col("n") * F.col("step_n")).alias("n"),
            )
        )
    return paths.select("start", "start_degree", "end", "inner", "n"), tasks


def _halves(edges: DataFrame, k: int, ranked: DataFrame | None = None) -> tuple[tuple[DataFrame, int], tuple[DataFrame, int]]:
    if k < 2:
        raise ValueError("a cycle needs k >= 2 vertices")
    if ranked is not None:
        ranked = stored(ranked)
    elif k == 2:  # no path is extended, so any ranking does
        no_degree = (F.lit(0).alias(f"{side}_degree") for side in ("src", "dst"))
        ranked = weighted_edges(edges).select("*", *no_degree)
    else:
        ranked = stored(ranked_edges(edges))
    reverse = ranked.select(
        F.col("dst").alias("src"),
        F.col("dst_degree").alias("src_degree"),
        F.col("src").alias("dst"),
        F.col("src_degree").alias("dst_degree"),
        "n",
    )
    return _half_cycles(ranked, k - k // 2), _half_cycles(reverse, k // 2)


def _met_halves(forward: DataFrame, backward: DataFrame, k: int) -> DataFrame:
    """``(start, end, inner, n, back, back_n)``: stored halves that meet.

    Halves of two edges at most leave their start by different edges, so not more of them meet in an end than the
    start's degree.  Only from hubs can that be more than a cell of a split key, so other halves need no counting.
    """
    on = ["start", "end"]
    back = backward.withColumnsRenamed({"inner": "back", "n": "back_n"})
    hub = F.col("start_degree") > (SPLIT_CELL_ROWS if k <= 4 else -1)

    def part(which: Column) -> tuple[DataFrame, DataFrame]:
        return forward.where(which).drop("start_degree"), back.where(which).drop("start_degree")

    others, hubs = part(~hub), part(hub)
    met = others[0].join(others[1], on)
    return met if hubs[0].isEmpty() else met.unionByName(balanced_join(*hubs, on))


def simple_cycles(edges: DataFrame, k: int) -> DataFrame:
    """``(cycle, n)``: each directed simple cycle of ``k`` vertices once, smallest id first."""
    forward, backward = (stored(half) for half, _ in _halves(edges, k))
    met = _met_halves(forward, backward, k).where(~F.arrays_overlap("inner", "back"))
    around = met.select(
        F.concat(F.array("start"), "inner", F.array("end"), F.reverse("back")).alias("cycle"),
        (F.col("n") * F.col("back_n")).alias("n"),
    ).withColumn("first", F.array_position("cycle", F.array_min("cycle")).cast("int"))
    rotated = F.concat(
        F.slice("cycle", F.col("first"), F.lit(k)),
        F.slice("cycle", F.lit(1), F.col("first") - 1),
    )
    return around.select(rotated.alias("cycle"), "n")


def _wide_sum(column: str) -> Column:
    """An exact sum of non-negative 64-bit numbers, which may be larger than such a number."""
    high, low = F.shiftright(column, 31), F.col(column).bitwiseAND((1 << 31) - 1)
    whole = "decimal(20,0)"
    return F.sum(high).cast(whole) * F.lit(1 << 31).cast("decimal(10,0)") + F.sum(low).cast(whole)


def count_cycles(edges: DataFrame, k: int) -> DataFrame:
    """``(n_cycles)``: number of directed simple cycles of ``k`` vertices, as ``DECIMAL(38, 0)``.

    No cycle is listed.  Halves between the same two vertices combine unless they share an inner vertex.  Pairs that share none
    are counted by inclusion and exclusion: over all sets of inner vertices, with alternating sign, the number of forward halves
    that pass the whole set times that of backward ones.  These are sums per pair of ends and set: no join.
    All halves between two vertices are counted in one task.  Cycles of five vertices in a graph of more than ``SENT_PATHS`` paths of two edges
    are counted where their halves are made, as most paths of three edges meet nothing (``cycle_scan``).
    """
    ranked = None
    if k == 5:
        known, degrees = _trimmed(edges)
        paths = degrees.agg(F.sum(F.col("out").cast("double") * (F.col("degree") - F.col("out")))).first()[0]
        if (paths or 0) > SENT_PATHS:
            return count_five_cycles(known, degrees)
        ranked = _with_degrees(known, degrees)
    (forward, tasks), (backward, back_tasks) = _halves(edges, k, ranked)
    most_shared = k // 2 - 1

    most_inner = k - k // 2 - 1 if most_shared else 0

    def bare(half: DataFrame, inner: int, own: str, other: str) -> DataFrame:
        none = F.lit(None).cast("bigint")
        passed = (
            (F.get("inner", F.lit(at)) if at < inner else none).alias(f"inner{at}") for at in range(most_inner)
        )
        counts = (F.col("n").alias(own), F.lit(0).cast("bigint").alias(other))
        return half.select("start", "end", *passed, F.lit(inner).alias("length"), *counts)

    # Each half is exchanged once and unfolded to its sets behind that, in tasks small enough to count them.
    width = max(SPREAD * shuffle_partitions(forward), tasks + back_tasks)
    halves = bare(forward, k - k // 2 - 1, "f", "b").unionByName(bare(backward, most_shared, "b", "f"))
    halves = halves.repartition(width, "start", "end")
    sets = [
        F.when(
            F.col("length") > max(places, default=-1),
            F.struct(
                F.lit((-1) ** size).alias("sign"),
                F.sort_array(F.array(*(F.col(f"inner{at}") for at in places)).cast("array<bigint>")).alias("shared"),
            ),
        )
        for size in range(most_shared + 1)
        for places in combinations(range(most_inner), size)
    ]
    keys = ["start", "end", "sign"]
    if most_shared:
        found = halves.select("start", "end", "f", "b", F.explode(F.array(*sets)).alias("set"))
        halves = found.where(F.col("set").isNotNull()).select("start", "end", "set.*", "f", "b")
        keys.append("shared")
    else:
        halves = halves.select("start", "end", F.lit(1).alias("sign"), "f", "b")
    met = halves.groupBy(*keys).agg((_wide_sum("f") * _wide_sum("b")).alias("n"))
    total = F.sum(F.col("sign") * F.col("n")).cast("decimal(38,0)")
    return met.agg(F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias("n_cycles"))
