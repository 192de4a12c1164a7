"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is its set of runs of ``SHINGLE`` words (lower-cased, cut at white space), weighted
by ``1 + ln(count)``.  Each shingle sends a Poisson process of arrivals, at a rate equal to its weight, to
``REGISTERS`` registers picked at random; a register keeps the shingle that arrives first.  Arrivals later
than the last register's are of no use, so each process ends as soon as it passes that time.  The share of equal
registers estimates the probability Jaccard similarity of two documents.  Texts that repeat a shingle are signed
once more with all weights 1: the share of equal registers of these signatures estimates the plain Jaccard
similarity, which the threshold is on.  Where no shingle is repeated both signatures are the same.

Bands of registers, of both signatures, make candidates.  A band's bucket may hold any number of documents: each member
is compared with the bucket's centre, never all with all.  The centre is the member whose other
buckets hold most documents, which is the text that the others derive from.  Candidates are verified on their
texts, by the exact Jaccard similarity of their shingle sets, unless the sizes of these sets or the registers of unit
weights rule it out.  Buckets whose members are then still in several classes get
two more centres, from their largest classes, until no new link is found.  What members of buckets with several classes
have then not been compared meet by a prefix filter on their rarest shingles, which misses no pair.

Equal texts are one text throughout, known by 128 bits of their content, and are not compared.
Texts of fewer than ``SHINGLE`` words are one shingle.  Null texts, and texts without words, are
equal only to texts that equal them; null equals null.  Rows that repeat an id are rows of their
own.  A class is named by its smallest id, or null if it has none.  Texts of any length are signed and compared whole.  An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termweave.llm.common import if_small, tidy, unused, written
from termweave.operators.skew import balanced_join, lookup_join

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS = 128
BAND = 4
# A candidate is dropped if its estimate is below the threshold by more than so many deviations.
DEVIATIONS = 4.5
# With so many members outside its largest class, a bucket's pairs of classes are all compared.
FEW_OUTSIDE = 16
# Shingles of more texts than this, or than one in so many of all shingles, come last in prefixes.
SELDOM = 32
COMMON = 200_000
KEPT_WORDS = 100_000
TOGETHER = 1 << 21

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words; frequent ones are kept."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS and len(word) <= 48:
            self[word] = value
        return value


def shingles(text: str, words: Words) -> np.ndarray:
    """Hashes of all runs of words of a text, repeats included."""
    cut = text.lower().split()
    hashes = np.fromiter(map(words.__getitem__, cut), np.uint64, len(cut))
    if not len(hashes):
        return hashes
    width = min(SHINGLE, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for at in range(width):
        out = mix(out * _STEP + hashes[at : at + n])
    return out


def signatures(
    sets: list[np.ndarray], registers: int = REGISTERS, weighted: bool = True
) -> np.ndarray:
    """ProbMinHash signatures, a row of 32-bit marks per set of shingles with repeats.

    Without weights each shingle of a set counts as one.
    """
    unique = [np.unique(s, return_counts=True) for s in sets]
    sizes = np.array([len(u) for u, _ in unique])
    out = np.zeros((len(sets), registers), dtype=np.uint64)
    if not sizes.sum():
        return out.astype(np.uint32)
    element = np.concatenate([u for u, _ in unique])
    rate = 1 + np.log(np.concatenate([c for _, c in unique]))
    if not weighted:
        rate = np.ones(len(element))
    owner = np.repeat(np.arange(len(sets)), sizes)
    first = np.full(len(sets) * registers, np.inf)
    flat = out.reshape(-1)
    time, state, names = np.zeros(len(element)), element, element
    latest = np.full(len(sets), np.inf)
    while len(names):
        state = mix(state + _STEP)
        draw = ((state >> np.uint64(11)) + 0.5) / float(1 << 53)
        time = time - np.log(draw) / rate
        alive = time < latest[owner]
        time, state, names = time[alive], state[alive], names[alive]
        rate, owner = rate[alive], owner[alive]
        if not len(names):
            break
        place = owner * registers + (mix(state) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(time < first[place])
        early = early[np.argsort(-time[early], kind="stable")]
        # Of several writes to a register the last one holds, which is the earliest arrival.
        first[place[early]] = time[early]
        flat[place[early]] = names[early]
        latest = first.reshape(len(sets), registers).max(axis=1)
    return (mix(out) >> np.uint64(32)).astype(np.uint32)


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """A 64-bit key per band and row; the band's number is part of it."""
    n, registers = signature.shape
    bands = registers // band
    groups = signature[:, : bands * band].reshape(n, bands, band).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
    for at in range(band):
        key = mix(key * _STEP + groups[:, :, at])
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct shingles."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


def _signed(texts: DataFrame) -> DataFrame:
    """``(rep, n, signature, bands)`` of ``(rep, text)`` with at least one word.

    ``n`` counts distinct shingles, ``signature`` is that of unit weights, ``bands`` are of both.
    """

    @tidy
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            reps, sets, size = [], [], 0
            for at, (rep, text) in enumerate(zip(batch["rep"], batch["text"], strict=True)):
                found = shingles(text or "", words)
                if len(found):
                    reps.append(rep)
                    sets.append(found)
                    size += len(found)
                if sets and (size >= 1 << 18 or at + 1 == len(batch)):
                    distinct = [np.unique(s) for s in sets]
                    signature = signatures(sets)
                    bands = list(band_keys(signature))
                    plain = [i for i, s in enumerate(sets) if len(distinct[i]) < len(s)]
                    if plain:
                        signature[plain] = signatures([distinct[i] for i in plain], weighted=False)
                        for i, keys in zip(plain, band_keys(signature[plain]), strict=True):
                            bands[i] = np.union1d(bands[i], keys)
                    yield pd.DataFrame(
                        {
                            "rep": reps,
                            "n": [len(s) for s in distinct],
                            "signature": [row.tobytes() for row in signature.astype("<u4")],
                            "bands": bands,
                        }
                    )
                    reps, sets, size = [], [], 0

    return texts.mapInPandas(sign, "rep binary, n long, signature binary, bands array<long>")


def _agree(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes and registers agree as those of pairs above the threshold do."""
    least = THRESHOLD - DEVIATIONS * math.sqrt(THRESHOLD * (1 - THRESHOLD) / REGISTERS)

    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series(dtype="float64")
        one = np.frombuffer(b"".join(x), "<u4").reshape(len(x), -1)
        two = np.frombuffer(b"".join(y), "<u4").reshape(len(y), -1)
        return pd.Series((one == two).mean(axis=1))

    a = marks.select(F.col("rep").alias("a"), F.col("signature").alias("sig_a"), F.col("n").alias("n_a"))
    b = marks.select(F.col("rep").alias("b"), F.col("signature").alias("sig_b"), F.col("n").alias("n_b"))
    sized = pairs.join(a, "a").join(b, "b").where(_sizes_allow("n_a", "n_b"))
    return sized.where(share("sig_a", "sig_b") >= least).select("a", "b")


def _sizes_allow(one: str, two: str) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return F.least(one, two) / F.greatest(one, two) >= THRESHOLD


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose shingle sets are similar enough, by their whole texts."""

    @F.pandas_udf("double")
    @tidy
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        words = Words()
        for one, two in batches:
            yield pd.Series(
                [
                    jaccard(np.unique(shingles(x, words)), np.unique(shingles(y, words)))
                    for x, y in zip(one, two, strict=True)
                ],
                dtype="float64",
            )

    # Only the texts of candidates leave their place.
    met = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    asked = texts.join(if_small(met), "rep", "left_semi")
    a = asked.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    b = asked.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    met = pairs.join(a, "a").join(b, "b")
    return met.where(similarity("text_a", "text_b") >= THRESHOLD).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``(rep, class)`` of ``(a, b)``: the smallest key that links lead to.

    Every round each node takes the smallest of its neighbours and itself, and then what that
    one took.  Links are carried over to the nodes taken, and those that now lead from a node
    to itself are gone, so a round has only what the one before left open: a star is done in
    one or two.  The smallest node of a class always stays.  All of it stays in tables.
    """
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = written(links.select(*ends).where("a != b").distinct())
    classes = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("near")))
        jump = taken.select(F.col("a").alias("near"), F.col("near").alias("class"))
        step = written(taken.join(jump, "near").select(F.col("a").alias("rep"), "class"))
        classes = step if classes is None else written(_relabelled(classes, step))
        at_a, at_b = (
            step.select(F.col("rep").alias(end), F.col("class").alias(f"to_{end}")) for end in "ab"
        )
        moved = edges.join(at_a, "a").join(at_b, "b").where("to_a != to_b")
        edges = written(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
        if edges.isEmpty():
            return classes


def _relabelled(classes: DataFrame, step: DataFrame) -> DataFrame:
    """``(rep, class)`` with the class that ``step`` gives a class, where it gives one."""
    further = step.select(F.col("rep").alias("class"), F.col("class").alias("further"))
    return classes.join(further, "class", "left").select(
        "rep", F.coalesce("further", "class").alias("class")
    )


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``(rep, class)`` after more links: only the classes that these lead to are merged."""
    known = classes.withColumnRenamed("class", "known")
    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    ends = written(ends.join(known, "rep", "left"))
    at_a, at_b = (
        ends.select(F.col("rep").alias(end), F.coalesce("known", "rep").alias(f"to_{end}"))
        for end in "ab"
    )
    between = links.join(at_a, "a").join(at_b, "b")
    step = components(between.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")))
    alone = ends.where("known IS NULL").select("rep", F.col("rep").alias("class"))
    return written(_relabelled(classes.unionByName(alone), step))


def _pairs(centres: DataFrame, members: DataFrame) -> DataFrame:
    """Each member with each of its bucket's centres, ``a < b``, once."""
    met = members.join(centres, "bucket").where(F.col("rep") != F.col("centre"))
    return met.select(
        F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")
    ).distinct()


def _across(members: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different classes in a bucket, of ``(bucket, rep, class, top)``."""
    one = members.where("class != top").select(
        "bucket", F.col("rep").alias("one"), F.col("class").alias("class_one")
    )
    met = members.join(one, "bucket").where(
        (F.col("class") != F.col("class_one"))
        & ((F.col("class") == F.col("top")) | (F.col("class_one") < F.col("class")))
    )
    return met.select(F.least("rep", "one").alias("a"), F.greatest("rep", "one").alias("b")).distinct()


def _unmet(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different classes, with all that reach the threshold, of ``(rep, class)``.

    Sets above the threshold share one of their first shingles in any order that is the same for all: as many of each set are
    its prefix as it may have beyond the share that must be common.  Shingles of many texts come last, by
    their number; the others, each of which few texts have, come by their hash.
    Pairs meet at the shingles of their prefixes, where the places left bound what else is common.
    """

    @tidy
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            found = [np.unique(shingles(text, words)).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"rep": batch["rep"], "class": batch["class"], "shingles": found})

    members = written(members)
    if members.isEmpty():
        return members.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    sets = texts.join(if_small(members), "rep").select("rep", "class", "text")
    # Rows that are equal in id and text stand once here.
    sets = sets.mapInPandas(listed, "rep binary, class binary, shingles array<long>")
    sets = written(sets.dropDuplicates(["rep"]))
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    common = max(SELDOM, total // COMMON)
    counts = sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    # At most COMMON rows, as each stands for so large a part of all.
    often = counts.where(F.col("n") > common).orderBy("shingle").collect()
    known = members.sparkSession.sparkContext.broadcast(
        (np.array([r["shingle"] for r in often], dtype=np.int64), np.array([r["n"] for r in often], dtype=np.int64))
    )

    @tidy
    def first_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, times = known.value
        for batch in batches:
            for rep, label, found in zip(batch["rep"], batch["class"], batch["shingles"], strict=True):
                n = np.zeros(len(found), dtype=np.int64)
                if len(seen):
                    at = np.minimum(np.searchsorted(seen, found), len(seen) - 1)
                    n[seen[at] == found] = times[at[seen[at] == found]]
                length = len(found) - math.ceil(THRESHOLD * len(found) - 1e-9) + 1
                prefix = found[np.lexsort((found, n))[:length]]
                yield pd.DataFrame(
                    {
                        "rep": [rep] * len(prefix),
                        "class": [label] * len(prefix),
                        "size": len(found),
                        "place": np.arange(1, len(prefix) + 1),
                        "shingle": prefix,
                    }
                )

    prefix = written(
        sets.mapInPandas(first_ones, "rep binary, class binary, size long, place long, shingle long")
    )
    # The largest class of a shingle meets the others, not itself, so near copies make no square.
    largest = (
        prefix.groupBy("shingle", "class")
        .agg(F.count("*").alias("n"))
        .groupBy("shingle")
        .agg(F.max(F.struct("n", "class")).alias("top"), F.sum("n").alias("n"))
        .where("top.n < n")
        .select("shingle", F.col("top.class").alias("top"), "n")
    )
    prefix = written(lookup_join(prefix, written(largest), "shingle", "n").drop("n"))
    one, two = (
        prefix.select(
            "shingle", *(F.col(c).alias(f"{c}_{end}") for c in ("rep", "class", "size", "place", "top"))
        )
        for end in "ab"
    )
    met = balanced_join(one.where("class_a != top_a"), two, ["shingle"])
    left = [F.col(f"size_{end}") - F.col(f"place_{end}") for end in "ab"]
    least = F.lit(THRESHOLD / (1 + THRESHOLD)) * (F.col("size_a") + F.col("size_b"))
    met = met.where(
        (F.col("class_a") != F.col("class_b"))
        & ((F.col("class_b") == F.col("top_b")) | (F.col("class_a") < F.col("class_b")))
        & _sizes_allow("size_a", "size_b")
        & (F.least(*left) + 1 >= least - F.lit(1e-9))
    )
    return met.select(
        F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")
    ).distinct()


def linked_classes(texts: DataFrame) -> DataFrame:
    """``(rep, class)`` of all texts with a link, of ``(rep, text)``."""
    signed = written(_signed(texts).dropDuplicates(["rep"]))
    marks = signed.select("rep", "n", "signature")
    slots = signed.select("rep", F.explode("bands").alias("bucket"))
    counts = slots.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(slots.join(counts, "bucket"))
    popular = members.groupBy("rep").agg(F.sum("n").alias("popularity"))
    members = written(members.select("rep", "bucket").join(popular, "rep"))
    rank = F.struct("popularity", "rep")
    centres = members.groupBy("bucket").agg(F.max_by("rep", rank).alias("centre"))
    tried = written(_pairs(centres, members))
    classes = components(_verified(_agree(tried, marks), texts))
    while True:
        # Buckets that still hold several classes: the classes' most popular members meet
        # the members of all other classes, unless they have met before.
        labelled = members.join(classes, "rep", "left").withColumn(
            "class", F.coalesce("class", "rep")
        )
        mixed = (
            labelled.groupBy("bucket")
            .agg(F.min("class").alias("low"), F.max("class").alias("high"))
            .where("low < high")
            .select("bucket")
        )
        open_members = written(labelled.join(mixed, "bucket"))
        heads = open_members.groupBy("bucket", "class").agg(
            F.max_by("rep", rank).alias("centre"), F.count("*").alias("size")
        )
        # Two heads a bucket: of the largest class, and of the largest other one.
        top = heads.groupBy("bucket").agg(
            F.max(F.struct("size", "class", "centre")).alias("first"),
        )
        second = (
            heads.join(top, "bucket")
            .where(F.col("class") != F.col("first.class"))
            .groupBy("bucket")
            .agg(F.max(F.struct("size", "class", "centre")).alias("second"))
        )
        chosen = (
            top.join(second, "bucket")
            .select("bucket", F.explode(F.array("first", "second")).alias("head"))
            .select(
                "bucket", F.col("head.centre").alias("centre"), F.col("head.class").alias("other")
            )
        )
        across = (
            open_members.join(chosen, "bucket")
            .where(F.col("class") != F.col("other"))
            .select(
                F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")
            )
            .distinct()
        )
        fresh = written(_agree(across.join(tried, ["a", "b"], "left_anti"), marks))
        more = written(_verified(fresh, texts))
        if more.isEmpty():
            # What is left: all pairs of different classes in a bucket, without the largest
            # class's own, where these are linear in its members; else the prefix filter.
            held = heads.groupBy("bucket").agg(F.sum("size").alias("all")).join(top, "bucket")
            outside = F.col("all") - F.col("first.size")
            held = written(held.select("bucket", outside.alias("outside"), F.col("first.class").alias("top")))
            few = open_members.join(held.where(F.col("outside") <= FEW_OUTSIDE), "bucket")
            direct = written(_across(few).join(tried, ["a", "b"], "left_anti"))
            many = open_members.join(held.where(F.col("outside") > FEW_OUTSIDE), "bucket")
            unmet = _unmet(many.select("rep", "class").distinct(), texts)
            left = written(_agree(direct, marks).unionByName(unmet).distinct())
            last = written(_verified(left, texts))
            return classes if last.isEmpty() else _joined(classes, last)
        classes = _joined(classes, more)
        tried = tried.unionByName(fresh)


def _content() -> Column:
    """128 bits that stand for a text; no bits stand for null."""
    return F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.lit(b""))


def _classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, content, class)``, a row for each row of ``(doc_id, text)``."""
    hashed = docs.select("doc_id", "text", _content().alias("rep"))
    keys = written(hashed.select("doc_id", "rep"))
    copies = (
        keys.groupBy("rep")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("rep", "first")
    )
    # One row a text, without moving texts; rows that are equal in all are equal below, too.
    texts = hashed.where("text IS NOT NULL")
    texts = (
        texts.join(if_small(written(copies)), "rep", "left")
        .where("first IS NULL OR doc_id = first")
        .select("rep", "text")
    )
    labels = linked_classes(texts)
    return keys.join(labels, "rep", "left").select(
        "doc_id", F.col("rep").alias("content"), F.coalesce("class", "rep").alias("class")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, class_id, copy_of)`` of ``(doc_id, text)``, a row for each row.

    ``copy_of`` is the smallest id with exactly this text, ``class_id`` the smallest id that
    links of similar texts lead to.
    """
    classes = written(_classes(docs))
    # A class, or the copies of a text, may be any share of the rows.
    class_ids = classes.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    copies = classes.groupBy("content").agg(F.min("doc_id").alias("copy_of"), F.count("*").alias("n"))
    named = written(lookup_join(classes, written(class_ids), "class", "n").drop("n"))
    return lookup_join(named, written(copies), "content", "n").select("doc_id", "class_id", "copy_of")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: the first by id, then by content.

    Rows with equal id and text are one document, of which one row stays.
    """
    classes = written(_classes(docs.select("doc_id", "text")))
    heads = classes.groupBy("class").agg(
        F.min(F.struct("doc_id", "content")).alias("head"), F.count("*").alias("members")
    )
    rows = written(classes.groupBy("class", "doc_id", "content").agg(F.count("*").alias("n")))
    id_name, content_name = unused(docs, "_id"), unused(docs, "_content")
    judged = lookup_join(rows, written(heads), "class", "members").select(
        F.struct("doc_id", "content").eqNullSafe(F.col("head")).alias("stays"),
        F.col("doc_id").alias(id_name),
        F.col("content").alias(content_name),
        "n",
    )
    judged = written(judged.where("NOT stays OR n > 1"))
    hashed = docs.withColumn(content_name, _content())

    def same(other: DataFrame) -> Column:
        return (hashed[content_name] == other[content_name]) & hashed["doc_id"].eqNullSafe(other[id_name])

    gone = if_small(judged.select(id_name, content_name))
    kept = hashed.join(gone, same(gone), "left_anti")
    repeated = judged.where("stays").select(id_name, content_name)
    if not repeated.isEmpty():
        again = hashed.join(repeated, same(repeated), "left_semi")
        kept = kept.unionByName(again.dropDuplicates(["doc_id", content_name]))
    return kept.drop(content_name)
