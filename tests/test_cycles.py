import random
from collections import Counter
from itertools import permutations

import pytest
from conftest import rows

from termweave.operators import cycle_scan, cycles
from termweave.plans import inputs

TEN_EDGES = [(0, 1), (0, 2), (1, 2), (1, 3), (2, 3), (2, 4), (3, 2), (3, 4), (4, 0), (4, 3)]


def graph(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


def count(spark, edges, k):
    return rows(cycles.count_cycles(graph(spark, edges), k))[0][0]


def brute_force(edges, k):
    """Cycles with the smallest vertex first, and their number of edge choices."""
    times = Counter((a, b) for a, b in edges if a != b)
    found = {}
    for around in permutations(sorted({v for edge in edges for v in edge}), k):
        if around[0] == min(around):
            n = 1
            for a, b in zip(around, around[1:] + around[:1], strict=True):
                n *= times[a, b]
            if n:
                found[around] = n
    return found


@pytest.mark.parametrize(
    ("k", "expected"),
    [
        (2, {(2, 3), (3, 4)}),
        (3, {(0, 2, 4), (2, 4, 3)}),
        (4, {(0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4)}),
        (5, {(0, 1, 2, 3, 4), (0, 1, 3, 2, 4)}),
        (6, set()),
    ],
)
def test_ten_edges(spark, k, expected):
    listed = rows(cycles.simple_cycles(graph(spark, TEN_EDGES), k))
    assert {tuple(cycle) for cycle, _ in listed} == expected
    assert len(listed) == len(expected) and all(n == 1 for _, n in listed)
    assert count(spark, TEN_EDGES, k) == len(expected)


@pytest.mark.parametrize(
    ("edges", "k", "expected"),
    [
        ([(0, 1), (0, 1), (1, 2), (2, 0)], 3, 2),
        ([(0, 0), (0, 1), (1, 0)], 2, 1),
        ([(9, 0), (0, 1), (1, 2), (2, 0)], 3, 1),
        ([(0, 1), (1, 0), (1, 2), (2, 3)], 4, 0),
    ],
    ids=["parallel edges", "self-loop", "vertex without in-edge", "starved vertex"],
)
def test_special_edges(spark, edges, k, expected):
    assert count(spark, edges, k) == expected


def test_short_cycles_are_refused(spark):
    with pytest.raises(ValueError, match="k >= 2"):
        cycles.count_cycles(graph(spark, TEN_EDGES), 1)


@pytest.mark.parametrize("k", [2, 3, 4, 5, 6, 7])
def test_random_graph_with_a_hub(spark, k):
    pick = random.Random(k)
    edges = [(pick.randrange(7), pick.randrange(7)) for _ in range(24)]
    edges += [(3, v) for v in range(7)] + [(v, 3) for v in range(7)]
    expected = brute_force(edges, k)
    listed = {tuple(cycle): n for cycle, n in rows(cycles.simple_cycles(graph(spark, edges), k))}
    assert listed == expected
    relabelled = [(10 - 3 * a, 10 - 3 * b) for a, b in edges]
    pick.shuffle(relabelled)
    assert count(spark, edges, k) == count(spark, relabelled, k) == sum(expected.values())


@pytest.mark.parametrize(("k", "copies"), [(3, 3_000_000), (5, 7_000)])
def test_counts_beyond_64_bits(spark, k, copies):
    """Parallel edges multiply; ``copies ** k`` does not fit a 64-bit number."""
    around = [(v, (v + 1) % k) for v in range(k)]
    edges = spark.range(copies).crossJoin(graph(spark, around)).select("src", "dst")
    assert copies**k > 1 << 63
    assert int(rows(cycles.count_cycles(edges, k))[0][0]) == copies**k


def test_chains_that_lead_nowhere_are_trimmed(spark):
    ring = [(0, 1), (1, 2), (2, 0)]
    chains = [(at, at + 1) for at in range(100, 112)] + [(112, 0)]  # into the ring
    chains += [(2, 200)] + [(at, at + 1) for at in range(200, 212)]  # out of it
    chains += [(300, 301), (301, 302), (300, 302)]  # apart
    trimmed = cycles.ranked_edges(graph(spark, ring + chains))
    assert sorted((r.src, r.dst) for r in trimmed.collect()) == sorted(ring)
    assert {r.src_degree for r in trimmed.collect()} == {2}
    assert count(spark, ring + chains, 3) == 1
    # Fewer rounds leave more edges, and the same count.
    few = cycles.ranked_edges(graph(spark, ring + chains), rounds=2)
    assert len(ring) < few.count() < len(ring + chains)
    assert rows(cycles.count_cycles(graph(spark, chains), 3)) == [(0,)]


def test_paths_and_vertices(spark):
    edges = [(0, 1), (0, 1), (1, 2), (1, 0), (2, 2), (2, 0)]
    assert {(tuple(p), n) for p, n in rows(cycles.simple_paths(graph(spark, edges), 3))} == {
        ((0, 1, 2), 2),
        ((1, 2, 0), 1),
        ((2, 0, 1), 2),
    }
    assert {v for (v,) in rows(cycles.vertices(graph(spark, edges)))} == {0, 1, 2}
    four = rows(cycles.simple_paths(graph(spark, TEN_EDGES), 4))
    assert all(len(set(path)) == 4 for path, _ in four)


@pytest.mark.parametrize("k", [3, 4, 5])
def test_a_half_cycle_is_exchanged_once(spark, k):
    """Sets of inner vertices are unfolded behind the exchange of the halves, and counted there."""
    edges = spark.createDataFrame([(a, b) for a in range(6) for b in range(6) if a != b], "src long, dst long")
    counted = cycles.count_cycles(edges, k)
    expected = {3: 40, 4: 90, 5: 144}[k]
    assert int(counted.first()[0]) == expected
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # From the top: the total's exchange, then that of the halves.
    behind = plan.split("Exchange")[1]
    assert behind.count("HashAggregate") == 3
    assert ("explode" in behind) == (k > 3)


@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_halves_that_meet_are_counted_at_hubs_only(spark, monkeypatch, k):
    """Halves of two edges are not counted by their ends unless their start is a hub; the cycles are the same."""
    edges = [(a, b) for a in range(6) for b in range(6) if a != b] + [(0, 1), (6, 0), (1, 6), (6, 7), (7, 6)]
    counted = []
    join_sides = cycles.balanced_join

    def noted(left, right, on, *rest, **named):
        counted.append(on)
        return join_sides(left, right, on, *rest, **named)

    monkeypatch.setattr(cycles, "balanced_join", noted)
    found = {}
    for cell_rows in (20_000, 10, 0):
        monkeypatch.setattr(cycles, "SPLIT_CELL_ROWS", cell_rows)
        counted.clear()
        found[cell_rows] = sorted(rows(cycles.simple_cycles(graph(spark, edges), k)))
        assert (["start", "end"] in counted) == (k == 5 or cell_rows < 20_000 and k > 2)
    assert found[20_000] == found[10] == found[0]
    assert sum(n for _, n in found[0]) == int(cycles.count_cycles(graph(spark, edges), k).first()[0])


def test_lines_of_orders_are_dealt_by_their_number(spark, monkeypatch, tmp_path):
    items = [(order, line % 7, line * 31 % 50) for order in range(20) for line in range(9)] + [(None, 1, 2)] * 3
    table = spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    few = inputs.edges(spark, str(tmp_path))
    monkeypatch.setattr(inputs, "TASK_ITEMS", 10)
    many = inputs.edges(spark, str(tmp_path))
    assert Counter(rows(many)) == Counter(rows(few))
    dealt = "REPARTITION_BY_NUM"
    assert dealt not in few._jdf.queryExecution().executedPlan().toString()
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert dealt in plan and ", 19)" in plan


@pytest.mark.parametrize("k", [3, 4, 5])
def test_halves_are_counted_in_tasks_by_their_number(spark, monkeypatch, k):
    edges = [(a, b) for a in range(6) for b in range(6) if a != b]
    expected = count(spark, edges, k)
    monkeypatch.setattr(cycles, "result_tasks", lambda sizes: 37)
    counted = cycles.count_cycles(graph(spark, edges), k)
    assert rows(counted)[0][0] == expected == sum(brute_force(edges, k).values())
    tasks = 41 if k == 3 else 74  # a half of one edge is not joined: the session's width, 4
    assert f", {tasks})" in counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(4))
def test_five_cycles_are_counted_where_their_halves_are_made(spark, monkeypatch, seed):
    """No path is exchanged or stored; the edges are, and are read by all tasks."""
    pick = random.Random(seed)
    edges = [(pick.randrange(12), pick.randrange(12)) for _ in range(60)] + [(1, 2)] * 3
    edges += [(hub, v) for hub in (3, -5) for v in range(9)] + [(v, 3) for v in range(9)]
    expected = sum(brute_force(edges, 5).values())
    assert expected > 0
    monkeypatch.setattr(cycles, "SENT_PATHS", 0)
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(cycle_scan, "CELL_HALVES", 20 * size)
        monkeypatch.setattr(cycle_scan, "ROW_EDGES", size)
        monkeypatch.setattr(cycle_scan, "MADE", size)
        counted = cycles.count_cycles(graph(spark, edges), 5)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "MapInArrow" in plan.split("Exchange")[1]  # that of the total
        assert int(counted.first()[0]) == expected


def test_five_cycles_beyond_64_bits_and_none(spark, monkeypatch):
    monkeypatch.setattr(cycles, "SENT_PATHS", 0)
    around = [(v, (v + 1) % 5) for v in range(5)]
    edges = spark.range(7_000).crossJoin(graph(spark, around)).select("src", "dst")
    assert int(cycles.count_cycles(edges, 5).first()[0]) == 7_000**5
    assert count(spark, [(0, 1), (1, 2), (2, 0), (2, 3), (3, 0)], 5) == 0
    assert count(spark, [], 5) == 0
