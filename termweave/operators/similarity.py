"""Exact R-S join of token sets by Jaccard similarity.

Records are ``(side, id, tokens)`` with ``side`` ``'r'`` or ``'s'``, ids unique within
a side, and tokens distinct within a record.  The join is prefix filtered: with tokens in one
global order, rarest first, two sets that are similar enough share a token in a
short prefix of each.

The order is a dictionary of dense numbers, so sets are sorted arrays of numbers from there on.  Tokens of
few records meet as they are, others within neighbouring classes of set size only.  Each set has a bitmap, folded to a
width that suits its size; bits in which two of them differ stand for tokens that the sets do not share, which rules out most false
candidates before any set moves.

Equal sets on one side are joined once, through the record with the smallest id, and
unfolded at the end, so a large group of copies costs no more than one record until
its pairs are part of the result.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.operators.rows import in_order, unnest
from termweave.operators.skew import TASK_CELL_ROWS, balanced_join, key_sizes, lookup_join, result_tasks
from termweave.runtime import SMALL, SORTED_NUMBERS, stored

SIMILARITY_DIGITS = 6
# The threshold is applied to the rounded similarity, so the filters let through all
# that could still round up to it.  The slack also covers float error in the bounds.
ROUNDING_SLACK = 5.01e-7
# Words of 64 bits in a set's bitmap.
BITMAP_WORDS = 16
# Widths to which it is folded, each half the next, and so many bits for each that may differ.
FOLDED_WORDS = (2, 4, 8)
FOLDED_BITS = 4
# Tokens of so many records meet without regard to the sizes of sets, and without being counted.
FEW_RECORDS = 256
INT_NUMBERS = 2**31 - 1


def two_sided(r: DataFrame, s: DataFrame) -> DataFrame:
    """``(side, id, tokens)`` of both inputs ``(id, tokens)``; repeated tokens count once."""
    return (
        r.withColumn("side", F.lit("r"))
        .unionByName(s.withColumn("side", F.lit("s")))
        .select("side", "id", F.array_distinct("tokens").alias("tokens"))
    )


def token_frequency(records: DataFrame) -> DataFrame:
    """``(token, freq)``: number of records of either side that hold the token."""
    tokens = unnest(records.select("tokens"), "tokens", "token")
    return tokens.groupBy("token").agg(F.count("*").alias("freq"))


def token_order(records: DataFrame) -> DataFrame:
    """``(token, freq, token_id)``: all tokens numbered from 0, rarest first, then by token.  A stored table."""
    return stored(in_order(token_frequency(records), "token_id", "freq", "token"))


def _bitmap() -> Column:
    """The bitmap of all ``token_id`` of a group."""
    place = F.pmod("token_id", F.lit(64 * BITMAP_WORDS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    words = (
        F.coalesce(F.bit_xor(F.when(F.shiftright(place, 6) == at, bit)), F.lit(0).cast("bigint"))
        for at in range(BITMAP_WORDS)
    )
    return F.array(*words).alias("bitmap")


def canonical_order(records: DataFrame, order: DataFrame | None = None, bitmap: bool = True) -> DataFrame:
    """``records`` with ``tokens`` as sorted numbers of ``token_order``, and a ``bitmap`` of the set.

    Records without tokens are left out.  ``records`` is read several times: pass a stored table.
    """
    keys = [column for column in records.columns if column != "tokens"]
    order = token_order(records) if order is None else order
    numbered = lookup_join(unnest(records, "tokens", "token"), order, key="token", weight="freq")
    tokens = F.sort_array(F.collect_list("token_id")).alias("tokens")
    return numbered.groupBy(*keys).agg(tokens, *([_bitmap()] if bitmap else []))


def bitmaps(sets: DataFrame) -> DataFrame:
    """``(id, size, bitmap)`` of the sets of one side.  A set's tokens are in one row, so only finished bitmaps are exchanged."""
    tokens = unnest(sets.select("id", "tokens"), "tokens", "token_id")
    return tokens.groupBy("id").agg(F.count("*").cast("int").alias("size"), _bitmap())


def folded(bitmap: Column, size: Column, threshold: float) -> Column:
    """``bitmap`` with its parts laid over one another, as narrow as suits a set of ``size`` tokens.

    A bit of the folded bitmap still is the parity of the tokens that have it.
    """
    lowest = lowest_similarity(threshold)
    bits = size * (2 * FOLDED_BITS * (1 - lowest) / (1 + lowest))
    narrow = F.lit(None)
    for words in reversed(FOLDED_WORDS):
        narrow = F.when(bits <= 64 * words, F.array(*_overlaid(bitmap, words))).otherwise(narrow)
    return F.coalesce(narrow, bitmap)


def all_widths(bitmap: Column) -> Column:
    """``bitmap`` folded to each width, the narrowest first, and itself, in one array."""
    return F.array(*(word for words in (*FOLDED_WORDS, BITMAP_WORDS) for word in _overlaid(bitmap, words)))


def _overlaid(bitmap: Column, words: int) -> list[Column]:
    parts = ([F.get(bitmap, F.lit(at)) for at in range(first, BITMAP_WORDS, words)] for first in range(words))
    return [reduce(Column.bitwiseXOR, part) for part in parts]


def with_tokens(rows: DataFrame, order: DataFrame) -> DataFrame:
    """``rows`` with ``token`` and ``freq`` of their ``token_id``; both are read several times."""
    return lookup_join(rows, order, key="token_id", weight="freq")


def lowest_similarity(threshold: float) -> float:
    """The smallest exact similarity that may still round to ``threshold``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    return max(threshold - ROUNDING_SLACK, ROUNDING_SLACK)


def prefixes(ordered: DataFrame, threshold: float, earlier: int = 0) -> DataFrame:
    """``(side, id, size, rank, token_id)``: the first ``size - ceil(t * size) + 1`` tokens.

    ``before1`` to ``before{earlier}`` are the tokens of the set just before each, null at its beginning.
    """
    size = F.size("tokens")
    length = (size - F.ceil(size * lowest_similarity(threshold)) + 1).cast("int")

    def entry(token: Column, at: Column) -> Column:
        before = (F.get("tokens", at - back).alias(f"before{back}") for back in range(1, earlier + 1))
        return F.struct((at + 1).alias("rank"), token.alias("token_id"), *before)

    entries = F.transform(F.slice("tokens", F.lit(1), length), entry)
    return ordered.select("side", "id", size.alias("size"), F.explode(entries).alias("entry")).select(
        "side", "id", "size", "entry.*"
    )


def _near(lowest: float) -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return (F.col("ssize") >= F.col("rsize") * lowest) & (F.col("rsize") >= F.col("ssize") * lowest)


def met_in_prefix(prefix: DataFrame, threshold: float) -> DataFrame:
    """Prefix tokens of both sides ``(token_id, size_class, rid, rsize, rrank, sid, ssize, srank)`` that meet."""
    return _met(prefix, threshold)[0]


def _earlier(prefix: DataFrame) -> list[str]:
    return [column for column in prefix.columns if column.startswith("before")]


def _met(prefix: DataFrame, threshold: float, order: DataFrame | None = None) -> tuple[DataFrame, int]:
    """``met_in_prefix``, and its number of tasks: dealt by what comes out, which may grow with the square of what goes in.

    Sizes fall into classes that grow by the factor of sizes that may still be similar.  A set of side ``s`` asks for the
    classes of its own smallest to largest possible partner, three at most; others it never meets.  With the ``order``, tokens of
    few records have one class: a row of theirs is sent once, and meets few. What they make is bounded by their frequencies.
    """
    lowest = lowest_similarity(threshold)

    def size_class(size: Column) -> Column:
        return F.floor(F.ln(size) / -math.log(lowest))

    r, s = (
        prefix.where(F.col("side") == side).select(
            "token_id",
            F.col("id").alias(f"{side}id"),
            F.col("size").alias(f"{side}size"),
            F.col("rank").alias(f"{side}rank"),
            *(F.col(column).alias(f"{side}{column}") for column in _earlier(prefix)),
        )
        for side in ("r", "s")
    )
    classed, besides = F.lit(True), 0.0
    if order is not None:
        few = order.where(F.col("freq") <= FEW_RECORDS)
        met = F.sum(F.when(F.col("freq") > 1, F.col("freq") * F.col("freq") / 4))  # most if half are of each side
        known = few.agg(F.count("*").alias("n"), F.coalesce(met, F.lit(0.0)).alias("met")).first()
        classed, besides = F.col("token_id") >= known["n"], known["met"]
    one = F.lit(-1).cast("bigint")
    r = r.withColumn("size_class", F.when(classed, size_class(F.col("rsize"))).otherwise(one))
    smallest = F.greatest(F.lit(1), F.ceil(F.col("ssize") * lowest - 1e-9))
    largest = F.floor(F.col("ssize") / lowest + 1e-9)
    asked = F.sequence(size_class(smallest), size_class(largest))
    s = s.withColumn("size_class", F.explode(F.when(classed, asked).otherwise(F.array(one))))
    on = ["token_id", "size_class"]
    # Keys of few records need no splitting.
    sizes = key_sizes(r.where(classed), s.where(classed), on)
    tasks = result_tasks(sizes, besides=besides)
    return balanced_join(r, s, on, cell_rows=TASK_CELL_ROWS, sizes=sizes, tasks=tasks), tasks


def candidates(
    prefix: DataFrame, threshold: float, positional: bool = False, order: DataFrame | None = None
) -> DataFrame:
    """``(rid, sid)``: pairs that share a prefix token and are of compatible size, once each.

    ``positional`` also asks that the tokens from the shared one on suffice for the
    overlap the threshold needs.  The first token a pair shares passes if any does, so
    no similar pair is lost.  ``prefix`` is read several times.  With the ``order``, tokens of
    one record, which meet nothing, are left out beforehand.  A meeting is passed over where the
    prefixes' ``earlier`` tokens show that the pair shares one of those: it also meets there.
    """
    lowest = lowest_similarity(threshold)
    near = _near(lowest)
    if order is not None:  # rarest first, so they have the first numbers
        prefix = prefix.where(F.col("token_id") >= order.where("freq = 1").count())
    if positional:
        most = F.least(F.col("rsize") - F.col("rrank"), F.col("ssize") - F.col("srank")) + 1
        near &= most >= (F.col("rsize") + F.col("ssize")) * (lowest / (1 + lowest))
    for a, b in product(_earlier(prefix), repeat=2):  # the pair met before
        near &= ~F.coalesce(F.col(f"r{a}") == F.col(f"s{b}"), F.lit(False))
    met, tasks = _met(prefix, threshold, order)
    # Pairs are told apart behind the exchange, in tasks of bounded size, and not before it as well.
    return met.where(near).select("rid", "sid").repartition(tasks, "rid", "sid").distinct()


def bitmaps_allow(threshold: float) -> Column:
    """Whether the bitmaps of two sets ``(rsize, rbitmap, ssize, sbitmap)`` allow the similarity.

    ``rbitmap`` may be ``folded`` if ``sbitmap`` is in ``all_widths``.  A bit that differs is due to a token of one set only, and each token has one bit.  So at least as many
    tokens are not shared as bits differ.
    """
    lowest = lowest_similarity(threshold)
    first = F.size("sbitmap") + F.size("rbitmap") - 2 * BITMAP_WORDS  # of the same width
    words = (
        F.coalesce(F.bit_count(F.get("rbitmap", F.lit(at)).bitwiseXOR(F.get("sbitmap", first + at))), F.lit(0))
        for at in range(BITMAP_WORDS)
    )
    sizes = F.col("rsize") + F.col("ssize")
    return (sizes - reduce(add, words)) / 2 >= sizes * (lowest / (1 + lowest)) - 1e-9


def jaccard(r: Column, s: Column) -> Column:
    """Jaccard similarity of two arrays of distinct items, rounded half up."""
    shared = F.size(F.array_intersect(r, s))
    return F.round(shared / (F.size(r) + F.size(s) - shared), SIMILARITY_DIGITS)


def _digest(tokens: Column) -> Column:
    """Identity of a token set; JSON keeps apart what a plain join of strings would not."""
    return F.sha2(F.to_json(F.array_sort(tokens)), 256)


def set_similarity_join(r: DataFrame, s: DataFrame, threshold: float) -> DataFrame:
    """``(rid, sid, sim)`` of all pairs whose rounded similarity reaches the threshold."""
    return join_records(two_sided(r, s), threshold)


def join_records(records: DataFrame, threshold: float) -> DataFrame:
    """``set_similarity_join`` of both sides in one table ``(side, id, tokens)``."""
    content = F.concat("side", _digest(F.col("tokens"))).alias("content")
    records = stored(records.where(F.size("tokens") > 0).select("side", "id", "tokens", content), **SMALL)
    members = _copies(records)
    # One record of each content: the others are left out by their ids, so token arrays stay where they are.
    others = members.where("id != first_id").select("side", "id")
    distinct_sets = records.drop("content").join(others, ["side", "id"], "left_anti")
    order = token_order(records)
    if order.count() <= INT_NUMBERS:
        order = order.withColumn("token_id", F.col("token_id").cast("int"))
    sets = stored(canonical_order(distinct_sets, order, bitmap=False), **SORTED_NUMBERS, **SMALL)
    pairs = stored(candidates(prefixes(sets, threshold), threshold, positional=True, order=order))

    def known(side: str, **columns: Column) -> DataFrame:
        named = (column.alias(f"{side}{name}") for name, column in columns.items())
        return sets.where(F.col("side") == side).select(F.col("id").alias(f"{side}id"), *named)

    def marks(side: str) -> DataFrame:
        own = bitmaps(sets.where(F.col("side") == side))
        return own.select(*(F.col(column).alias(f"{side}{column}") for column in own.columns))

    narrow = folded(F.col("rbitmap"), F.col("rsize"), threshold).alias("rbitmap")
    wide = all_widths(F.col("sbitmap")).alias("sbitmap")
    # The pairs carry the narrow ones.
    marked = pairs.join(marks("r").select("rid", "rsize", narrow), "rid").join(
        marks("s").select("sid", "ssize", wide), "sid"
    )
    likely = stored(marked.where(bitmaps_allow(threshold)).select("rid", "sid"))
    # Only the sets of one side move with the pairs.  All keys are counted on the bare pairs.
    r, s = (known(side, tokens=F.col("tokens")) for side in ("r", "s"))
    met = balanced_join(balanced_join(likely, r, ["rid"]), s, ["sid"], sizes=key_sizes(likely, s, ["sid"]))
    sim = jaccard(F.col("rtokens"), F.col("stokens")).alias("sim")
    similar = met.select("rid", "sid", sim).where(F.col("sim") >= threshold)
    return _unfold_copies(stored(similar), members)


def _copies(records: DataFrame) -> DataFrame:
    """``(side, id, first_id)`` of all records that equal another one of their side; the first has the smallest id."""
    firsts = records.groupBy("side", "content").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies")
    )
    copied = stored(firsts.where("copies > 1"))
    contents = records.select("content", "id")
    return stored(lookup_join(contents, copied, key="content", weight="copies").select("side", "id", "first_id"))


def _unfold_copies(similar: DataFrame, members: DataFrame) -> DataFrame:
    """Replace each set by all the records that equal it."""
    for side in ("r", "s"):
        own = members.where(F.col("side") == side)
        ids = F.col("first_id").alias(f"{side}id")
        unfolded = balanced_join(similar, own.select(ids, F.col("id").alias("member")), [f"{side}id"])
        alone = similar.join(own.select(ids).distinct(), f"{side}id", "left_anti")
        similar = alone.unionByName(unfolded.withColumn(f"{side}id", F.col("member")).drop("member"))
        if side == "r":  # the next joins read their input several times
            similar = stored(similar)
    return similar.select("rid", "sid", "sim")
