import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from termweave.operators import candidate_scan, similarity
from termweave.runtime import SORTED_NUMBERS, stored
from termweave.sources import similarity_lines

R = [(0, [1, 4, 5, 6]), (1, [2, 3, 6]), (2, [4, 5, 6])]
S = [(0, [1, 4, 6]), (1, [2, 5, 6]), (2, [3, 5])]


def side(spark, records):
    data = [(i, [str(token) for token in tokens]) for i, tokens in records]
    return spark.createDataFrame(data, "id long, tokens array<string>")


def join(spark, r, s, threshold):
    return rows(similarity.set_similarity_join(side(spark, r), side(spark, s), threshold))


def brute_force(r, s, threshold):
    found = []
    for rid, a in r:
        for sid, b in s:
            shared = len(set(a) & set(b))
            if shared and round(shared / len(set(a) | set(b)), 6) >= threshold:
                found.append((rid, sid, round(shared / len(set(a) | set(b)), 6)))
    return sorted(found)


@pytest.mark.parametrize(
    ("threshold", "expected"),
    [
        (0.3, [(0, 0, 0.75), (0, 1, 0.4), (1, 1, 0.5), (2, 0, 0.5), (2, 1, 0.5)]),
        (0.5, [(0, 0, 0.75), (1, 1, 0.5), (2, 0, 0.5), (2, 1, 0.5)]),
        (0.8, []),
    ],
)
def test_small_sets(spark, threshold, expected):
    assert sorted(join(spark, R, S, threshold)) == expected


def test_token_order_does_not_matter(spark):
    turned = [(i, tokens[::-1]) for i, tokens in R]
    assert sorted(join(spark, R, turned, 0.8)) == [(0, 0, 1.0), (1, 1, 1.0), (2, 2, 1.0)]


def test_pairs_at_the_exact_bound(spark):
    small, large = [(1, list(range(14)))], [(2, list(range(25)))]
    assert join(spark, small, large, 0.56) == [(1, 2, 0.56)]
    assert join(spark, large, small, 0.56) == [(2, 1, 0.56)]


def test_repeated_tokens_and_empty_records(spark):
    assert join(spark, [(1, ["a", "a", "b"]), (2, [])], [(1, ["b", "a"]), (2, [])], 1.0) == [
        (1, 1, 1.0)
    ]


@pytest.mark.parametrize("threshold", [0, -0.5, 1.01])
def test_thresholds_out_of_range(spark, threshold):
    with pytest.raises(ValueError, match="threshold"):
        join(spark, R, S, threshold)


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.75, 0.9])
def test_equals_brute_force_with_copies(spark, threshold, monkeypatch):
    # Small enough limits that the copies are split into several cells.
    monkeypatch.setattr(similarity.balanced_join, "__defaults__", (1000, 5))
    pick = random.Random(int(threshold * 100))

    def records():
        drawn = [pick.sample(range(12), pick.randint(0, 9)) for _ in range(25)]
        return list(enumerate(drawn + [list(range(6))] * 13))

    r, s = records(), records()
    assert sorted(join(spark, r, s, threshold)) == brute_force(r, s, threshold)


def test_canonical_order_and_prefix(spark):
    both = similarity.two_sided(side(spark, R), side(spark, S))
    frequency = dict(rows(similarity.token_frequency(both)))
    assert frequency == {"1": 2, "2": 2, "3": 2, "4": 3, "5": 4, "6": 5}
    order = similarity.token_order(both)
    names = {number: token for token, _, number in rows(order)}
    assert [names[at] for at in range(6)] == sorted(frequency, key=lambda t: (frequency[t], t))
    ordered = similarity.canonical_order(both, order)
    for record in ordered.collect():
        assert record.tokens == sorted(record.tokens)
    prefix = similarity.prefixes(ordered, 0.5).where("side = 'r' AND id = 0")
    named = similarity.with_tokens(prefix, order).orderBy("rank")
    assert [(r.side, r.id, r.size, r.rank, r.token, r.freq) for r in named.collect()] == [
        ("r", 0, 4, 1, "1", 2),
        ("r", 0, 4, 2, "4", 3),
        ("r", 0, 4, 3, "5", 4),
    ]


def drawn_sets(spark, seed, n=150):
    """Sets of very different sizes over few tokens, so that many share a prefix token."""
    pick = random.Random(seed)
    return side(
        spark, [(i, pick.sample(range(400), int(2 ** pick.uniform(1, 8)))) for i in range(n)]
    )


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 0.95, 1.0])
def test_only_neighbouring_sizes_meet(spark, threshold):
    both = similarity.two_sided(drawn_sets(spark, 1), drawn_sets(spark, 2))
    sets = similarity.canonical_order(both)
    prefix = similarity.prefixes(sets, threshold)
    met = similarity.met_in_prefix(prefix, threshold)
    lowest = similarity.lowest_similarity(threshold)
    near = (F.col("ssize") >= F.col("rsize") * lowest) & (F.col("rsize") >= F.col("ssize") * lowest)
    n, fit = met.count(), met.where(near).count()
    assert 0 < fit <= n <= 2 * fit
    # None that the plain join on tokens finds is lost, and none is found twice.
    r, s = (
        prefix.where(F.col("side") == x).select("token_id", F.col("id").alias(f"{x}id"), F.col("size").alias(f"{x}size"))
        for x in "rs"
    )
    assert r.join(s, "token_id").where(near).count() == fit


def test_bitmaps_rule_out_most_false_candidates(spark):
    both = similarity.two_sided(drawn_sets(spark, 3), drawn_sets(spark, 4))
    sets = similarity.canonical_order(both).collect()
    tokens = {(s.side, s.id): (set(s.tokens), s.bitmap) for s in sets}
    pairs = [
        (len(a), m, len(b), o, len(a & b) / len(a | b))
        for (one, _), (a, m) in tokens.items()
        for (two, _), (b, o) in tokens.items()
        if one == "r" and two == "s" and 0.8 <= len(a) / len(b) <= 1.25
    ]
    kinds = "rsize int, rbitmap array<bigint>, ssize int, sbitmap array<bigint>, sim double"
    table = spark.createDataFrame(pairs, kinds).withColumn("kept", similarity.bitmaps_allow(0.8))
    true, false, kept = table.agg(
        *(F.count_if(F.expr(c)) for c in ("sim >= 0.8", "sim < 0.8 AND kept", "sim >= 0.8 AND kept"))
    ).first()
    assert kept == true and false < 0.1 * (len(pairs) - true)


def test_numbers_take_a_third_of_names(spark, tmp_path):
    """Stored bytes of the ordered sets, against those of (frequency, token) structs."""
    words = spark.range(400).select(
        F.lit("r").alias("side"),
        "id",
        F.expr("transform(sequence(1, 300), x -> concat('token', pmod(xxhash64(id, x), 300000)))").alias("tokens"),
    )
    records = stored(words.select("side", "id", F.array_distinct("tokens").alias("tokens")))
    order = similarity.token_order(records)
    sets = similarity.canonical_order(records, order)
    items = sets.select("side", "id", F.posexplode("tokens").alias("at", "token_id"))
    structs = (
        similarity.with_tokens(items, order)
        .groupBy("side", "id")
        .agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("tokens"))
    )
    sizes = []
    for name, table, options in (("ids", sets.drop("bitmap"), SORTED_NUMBERS), ("structs", structs, {})):
        table.coalesce(1).write.options(**options).parquet(str(tmp_path / name))
        sizes.append(sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet")))
    assert 3 * sizes[0] <= sizes[1]


def test_text_order(spark):
    pairs = spark.createDataFrame(
        [(10, 1, 0.9), (9, 20, 0.826923), (9, 3, 1.0)], "rid long, sid long, sim double"
    )
    assert [v for (v,) in rows(similarity_lines(pairs))] == [
        "(9,3)\t1.0",
        "(9,20)\t0.826923",
        "(10,1)\t0.9",
    ]


def test_pairs_that_meet_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    """Few records in, many pairs out: the tasks follow the pairs, and a task tells apart no more than its share."""
    monkeypatch.setattr(similarity.result_tasks, "__defaults__", (1_000,))
    many = [(i, [1, 2, 3, 4, 5, 6, 7, 8, 9, 100 + i]) for i in range(60)]
    records = stored(similarity.two_sided(side(spark, many), side(spark, many)))
    order = similarity.token_order(records)
    prefix = stored(similarity.prefixes(similarity.canonical_order(records, order), 0.5, earlier=2))
    found = similarity.candidates(prefix, 0.5, order=order)
    plain = similarity.candidates(prefix.drop("before1", "before2"), 0.5)
    assert set(rows(found)) == set(rows(plain)) == {(r, s) for r in range(60) for s in range(60)}
    assert found.count() == 3_600
    sizes = [n for (n,) in rows(found.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)"))]
    assert len(sizes) > 10 and max(sizes) < 1_000


def test_earlier_tokens_of_a_prefix_lose_no_pair(spark):
    rng = random.Random(11)
    r, s = ([(i, rng.sample(range(14), rng.randint(1, 12))) for i in range(80)] for _ in "rs")
    r, s = r + [(80, [900])], s + [(80, [901])]
    records = stored(similarity.two_sided(side(spark, r), side(spark, s)))
    order = similarity.token_order(records)
    sets = stored(similarity.canonical_order(records, order))
    plain = rows(similarity.candidates(similarity.prefixes(sets, 0.6), 0.6))
    for earlier in (1, 2, 3):
        prefix = stored(similarity.prefixes(sets, 0.6, earlier))
        assert sorted(rows(similarity.candidates(prefix, 0.6, order=order))) == sorted(plain)
    first = prefix.where("rank = 1").select("before1").distinct()
    assert rows(first) == [(None,)]


def test_sets_of_one_side_only_move_with_the_pairs(spark, monkeypatch):
    joined = []
    join_sides = similarity.balanced_join

    def noted(left, right, on, *rest, **named):
        joined.append((left.columns, on))
        return join_sides(left, right, on, *rest, **named)

    monkeypatch.setattr(similarity, "balanced_join", noted)
    assert sorted(join(spark, R, S, 0.5)) == [(0, 0, 0.75), (1, 1, 0.5), (2, 0, 0.5), (2, 1, 0.5)]
    moved = [on for left, on in joined if "rtokens" in left]
    assert moved == [["sid"]]
    # Nothing is joined on whole pairs, with the sets of both sides on the way.
    assert ["rid", "sid"] not in [on for _, on in joined]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_pairs_carry_folded_bitmaps(spark, threshold):
    """Small sets have narrow ones, that lose no similar pair and still rule out most others."""
    sets = stored(similarity.canonical_order(similarity.two_sided(drawn_sets(spark, 5), drawn_sets(spark, 5)), bitmap=False))
    assert "bitmap" not in sets.columns

    def marks(side, bitmap):
        own = similarity.bitmaps(sets.where(F.col("side") == side))
        kept = own.select("id", "size", bitmap.alias("bitmap"))
        return kept.join(sets.where(F.col("side") == side).select("id", "tokens"), "id").select(
            *(F.col(c).alias(f"{side}{c}") for c in ("id", "size", "bitmap", "tokens"))
        )

    narrow = marks("r", similarity.folded(F.col("bitmap"), F.col("size"), threshold))
    assert narrow.where("rsize < 10 AND size(rbitmap) > 2").count() == 0
    assert narrow.where("size(rtokens) <> rsize").count() == 0
    met = narrow.join(marks("s", similarity.all_widths(F.col("bitmap"))), F.col("rsize").between(F.col("ssize") * 0.5, F.col("ssize") * 2))
    sim = similarity.jaccard(F.col("rtokens"), F.col("stokens"))
    judged = met.select(sim.alias("sim"), similarity.bitmaps_allow(threshold).alias("kept"))
    true, lost, false, n = judged.agg(
        F.count_if(F.col("sim") >= threshold),
        F.count_if((F.col("sim") >= threshold) & ~F.col("kept")),
        F.count_if((F.col("sim") < threshold) & F.col("kept")),
        F.count("*"),
    ).first()
    assert true >= 150 and lost == 0 and false < 0.2 * n


def test_tokens_of_few_records_are_sent_once(spark, monkeypatch):
    sent = []
    join_sides, count_keys = similarity.balanced_join, similarity.key_sizes

    def noted(left, right, *rest, **named):
        sent.append((left.count(), right.count()))
        return join_sides(left, right, *rest, **named)

    def counted(left, right, on):
        sent.append((left.count(), right.count()))
        return count_keys(left, right, on)

    monkeypatch.setattr(similarity, "balanced_join", noted)
    monkeypatch.setattr(similarity, "key_sizes", counted)
    records = stored(similarity.two_sided(drawn_sets(spark, 6), drawn_sets(spark, 7)))
    order = stored(similarity.token_order(records))
    prefix = stored(similarity.prefixes(similarity.canonical_order(records, order), 0.8))
    plain = sorted(rows(similarity.candidates(prefix, 0.8)))
    sent.clear()
    for few in (similarity.FEW_RECORDS, 36):  # all tokens, and some
        monkeypatch.setattr(similarity, "FEW_RECORDS", few)
        assert sorted(rows(similarity.candidates(prefix, 0.8, order=order))) == plain
    several = prefix.where(F.col("token_id") >= order.where("freq = 1").count())
    own = tuple(several.where(F.col("side") == side).count() for side in "rs")
    assert sent[:2] == [(0, 0), own]
    assert 0 < sent[2][0] < own[0] and sent[3][0] == own[0] and sent[3][1] > own[1]


@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.8, 1.0])
def test_candidates_are_told_apart_without_being_exchanged(spark, monkeypatch, threshold):
    for name, size in (("MADE", 20), ("CELL_TOKENS", 30), ("CHUNK_TOKENS", 50)):
        monkeypatch.setattr(candidate_scan, name, size)
    pick = random.Random(9)
    sets = [(at, pick.sample("abcdefghijklmnopqrst", pick.randint(1, 12))) for at in range(120)]
    one_id = [(None, ["a", "b"]), (None, ["b", "c"]), (500, ["a", "c"]), (500, ["a", "c"]), (501, [])]
    records = stored(similarity.two_sided(side(spark, sets[:60] + one_id), side(spark, sets[50:] + one_id)))
    order = similarity.token_order(records)
    ordered = stored(similarity.canonical_order(records, order, bitmap=False))
    plain = rows(similarity.candidates(similarity.prefixes(ordered, threshold), threshold))
    found = candidate_scan.scanned_candidates(ordered, similarity.lowest_similarity(threshold), order)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan.partition("Exchange")[0]  # only the sets of cells are exchanged, before they meet
    assert plan.count("Exchange") == 1
    assert "Aggregate" not in plan
    found = rows(found)
    assert len(found) == len(set(found))
    assert set(found) == set(plain)


def test_no_candidates_of_one_side(spark):
    records = stored(similarity.two_sided(side(spark, [(1, ["a"]), (2, ["a"])]), side(spark, [])))
    order = similarity.token_order(records)
    ordered = similarity.canonical_order(records, order, bitmap=False)
    assert rows(candidate_scan.scanned_candidates(ordered, 0.5, order)) == []
