"""Repeated passages by relative Lempel-Ziv parsing against indexed blocks of the corpus itself.

A window is ``WINDOW`` consecutive words of one text.  Windows are the symbols of the parse: a factor of ``n``
windows is a passage of ``n + WINDOW - 1`` words.  A text is cut into stretches of windows that have the
same smallest hash of ``ANCHOR`` words; equal windows have it in common, so all that can match a
stretch lies in the reference block that this hash is dealt to.  A block orders its stretches by
document, indexes every window by its first place, and parses each stretch from left to right: a factor
follows its source as far as the next windows agree, and at its boundary the next window is looked up
anew, so a window across two factors is found as well.  Factors whose source is in a document of smaller id
are spans to remove.  Equal stretches of one batch travel once, with the places where they stand.

No block grows beyond its share: hashes that many stretches have (``CROWDED``) are counted first, by what
each batch meets more than once, and their stretches are cut into single windows instead, whose first document
is an aggregate and is joined back by ``lookup_join``.

Windows are compared by 64 bits, inside their block.  Null texts have no words.  Rows without id neither
remove nor lose anything, nor do equal texts of one id to one another; texts shorter than a window stay
whole.  Rows that are equal in id and text get the same result.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import tidy, written
from termweave.operators.skew import lookup_join

WINDOW = 13
ANCHOR = 5
# Words of a batch, windows of a block and of a stretch.
BATCH_WORDS = 1 << 20
BLOCK_WINDOWS = 1 << 19
LONGEST = 16
# A hash with more stretches than this, and two a batch, is not parsed in a block.
CROWDED = 1 << 16
KEPT_WORDS = 50_000

# Fixed value: what a word is.
WORDS = re.compile("[^\x20\x09-\x0d]+")

_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(33)
_PACKED = (
    "block int, ids binary, texts binary, sizes binary, windows binary,"
    " members binary, doc binary, start binary"
)
_SPANS = "doc_id long, text_hash long, spans binary"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _SHIFT)) * _MIX_1
    x = (x ^ (x >> _SHIFT)) * _MIX_2
    return x ^ (x >> _SHIFT)


class Hashes(dict):
    """64-bit hashes of words; those met first are kept, and frequent words are met early."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < KEPT_WORDS and len(word) <= 32:
            self[word] = value
        return value


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on."""
    n = max(0, len(words) - width + 1)
    out = np.full(n, width, dtype=np.uint64)
    for at in range(width):
        out = mix(out * _STEP + words[at : at + n])
    return out


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` values from each place on."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[: len(values) - step], values[step:])
        have += step
    return values


class Stretches:
    """All stretches of a batch of texts, given as one array of word hashes and their lengths."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        self.windows = _grams(words, WINDOW)
        anchors = _smallest(_grams(words, ANCHOR), WINDOW - ANCHOR + 1)[: len(self.windows)]
        owner = np.repeat(np.arange(len(lengths)), lengths)[: len(self.windows)]
        places = np.arange(len(self.windows))
        # Windows that run past their text are none.
        self.at = np.flatnonzero(places + WINDOW <= ends[owner]) if len(places) else places
        owner, anchors = owner[self.at], anchors[self.at]
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
        # Long stretches are cut; their pieces keep their hash, and so their block.
        run = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        new |= (np.arange(len(new)) - run) % LONGEST == 0
        self.first = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.first, len(new)))
        self.anchor, self.doc = anchors[self.first], owner[self.first]
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        self.start = self.at[self.first] - begins[self.doc] if len(self.first) else self.first
        self.windows = self.windows[self.at]

    def window_places(self, chosen: np.ndarray) -> np.ndarray:
        """Places in ``windows`` of all windows of the chosen stretches."""
        sizes = self.sizes[chosen]
        before = np.cumsum(sizes) - sizes
        return np.repeat(self.first[chosen] - before, sizes) + np.arange(sizes.sum())


def _batches(
    frames: Iterator[pd.DataFrame], hashes: Hashes, limit: int
) -> Iterator[tuple[np.ndarray, np.ndarray, Stretches]]:
    """Ids, text hashes and stretches of some ``limit`` words at a time; short texts have none."""
    ids, texts, words, size = [], [], [], 0

    def batch():
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        return (
            np.array(ids, dtype=np.int64),
            np.array(texts, dtype=np.int64),
            Stretches(np.concatenate(words), lengths),
        )

    for frame in frames:
        for doc_id, text_hash, text in zip(
            frame["doc_id"], frame["text_hash"], frame["text"], strict=True
        ):
            found = WORDS.findall(text)
            if len(found) < WINDOW:
                continue
            ids.append(doc_id)
            texts.append(text_hash)
            words.append(np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)))
            size += len(found)
            if size >= limit:
                yield batch()
                ids, texts, words, size = [], [], [], 0
    if ids:
        yield batch()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def _crowds(texts: DataFrame) -> tuple[int, DataFrame]:
    """How many windows there are, and ``(anchor)`` of all hashes with too many stretches for a block.

    A batch reports what it meets more than once.  What it leaves out is one stretch a batch and hash, so
    a hash beyond the limit has half of it reported at least.
    """

    @tidy
    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for _, _, found in _batches(frames, hashes, BATCH_WORDS):
            anchors, n = np.unique(found.anchor, return_counts=True)
            often = n > 1
            yield pd.DataFrame(
                {
                    "anchor": pd.array([None, *anchors[often].view(np.int64)], dtype="Int64"),
                    "n": np.concatenate([[len(found.windows)], n[often]]),
                    "batches": np.concatenate([[1], np.zeros(often.sum(), dtype=np.int64)]),
                }
            )

    reports = texts.mapInPandas(report, "anchor long, n long, batches long")
    counts = written(reports.groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("batches").alias("batches")))
    total = counts.where("anchor IS NULL").first()
    if total is None:
        return 0, counts.select("anchor")
    limit = CROWDED + 2 * total["batches"]
    # At most some 2 ** 20 hashes of 8 bytes: twice the stretches divided by the limit, which grows with the batches.
    return total["n"], written(counts.where(F.col("anchor").isNotNull() & (2 * F.col("n") > limit)).select("anchor"))


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs."""
    most = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32) if most <= np.iinfo(t).max)).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // n]
    return np.frombuffer(data, kind).astype(np.int64)


def _packed(ids: np.ndarray, texts: np.ndarray, found: Stretches, chosen: np.ndarray, blocks: int):
    """A row for each block that stretches of a batch are dealt to; equal ones stand once."""
    places = found.window_places(chosen)
    windows, sizes = found.windows[places], found.sizes[chosen]
    first = np.cumsum(sizes) - sizes
    within = np.arange(len(windows)) - np.repeat(first, sizes)
    marks = np.add.reduceat(mix(windows * _STEP + within.astype(np.uint64)), first)
    block = (mix(found.anchor[chosen]) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((windows[first], marks, sizes, block))
    new = np.ones(len(order), dtype=bool)
    for part in (block, sizes, marks, windows[first]):
        new[1:] &= part[order][1:] == part[order][:-1]
    new[1:] = ~new[1:]
    content = np.cumsum(new) - 1
    heads = order[new]
    cuts = np.flatnonzero(np.r_[True, block[order][1:] != block[order][:-1]])
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        members, own = order[a:b], content[a:b] - content[a]
        contents = heads[content[a] : content[b - 1] + 1]
        held = sizes[contents]
        at = np.repeat(first[contents] - (np.cumsum(held) - held), held) + np.arange(held.sum())
        docs, doc = np.unique(found.doc[chosen[members]], return_inverse=True)
        yield {
            "block": int(block[members[0]]),
            "ids": ids[docs].tobytes(),
            "texts": texts[docs].tobytes(),
            "sizes": held.astype(np.uint8).tobytes(),
            "windows": windows[at].tobytes(),
            "members": _narrow(np.bincount(own)),
            "doc": _narrow(doc),
            "start": _narrow(found.start[chosen[members]]),
        }


def parse(windows: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which windows of the stretches of a block a factor from an earlier document covers.

    ``docs`` is the document of each stretch, ``sizes`` its number of windows.
    """
    order = np.argsort(docs, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    size = sizes[order]
    # The reference: all stretches by document.
    begin = np.cumsum(size) - size
    at = np.repeat(first - begin, size) + np.arange(size.sum())
    reference, owner = windows[at], np.repeat(np.arange(len(size)), size)
    # Its index: the first place of each window.
    by = np.argsort(reference, kind="stable")
    new = np.r_[True, reference[by][1:] != reference[by][:-1]]
    source = np.empty(len(by), dtype=np.int64)
    source[by] = by[new][np.cumsum(new) - 1]
    doc = docs[order]
    covered = np.zeros(len(reference), dtype=bool)
    follows = np.full(len(size), -1, dtype=np.int64)  # where the factor of each stretch is in its source
    for step in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > step)
        place, held = begin[live] + step, follows[live]
        going = held >= 0
        further = np.minimum(held + 1, len(reference) - 1)
        going &= (owner[further] == owner[held]) & (reference[further] == reference[place])
        # At a factor's end the next window is looked up anew.
        anew = source[place]
        found = np.where(doc[owner[anew]] < doc[live], anew, -1)
        follows[live] = np.where(going, held + 1, found)
        covered[place] = follows[live] >= 0
    out = np.zeros(len(windows), dtype=bool)
    out[at] = covered
    return out


def _block_spans(group: pd.DataFrame) -> pd.DataFrame:
    """Spans ``(from, to)`` of words to remove, per document, of the packed rows of a block."""
    sizes, windows, ids, texts, content, starts = [], [], [], [], [], []
    n_contents = 0
    for row in group.itertuples(index=False):
        held = np.frombuffer(row.sizes, np.uint8).astype(np.int64)
        members = _wide(row.members, len(held))
        doc = _wide(row.doc, members.sum())
        sizes.append(held)
        windows.append(np.frombuffer(row.windows, np.uint64))
        ids.append(np.frombuffer(row.ids, np.int64)[doc])
        texts.append(np.frombuffer(row.texts, np.int64)[doc])
        content.append(np.repeat(np.arange(len(held)), members) + n_contents)
        starts.append(_wide(row.start, len(doc)))
        n_contents += len(held)
    sizes, windows, ids, texts, content, starts = map(
        np.concatenate, (sizes, windows, ids, texts, content, starts)
    )
    earliest = np.full(n_contents, np.iinfo(np.int64).max)
    np.minimum.at(earliest, content, ids)
    covered = parse(windows, sizes, earliest)
    # Runs of covered windows of each stretch, as words from its start.
    owner = np.repeat(np.arange(n_contents), sizes)
    within = np.arange(len(windows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    begins = covered & np.r_[True, ~covered[:-1] | (owner[1:] != owner[:-1])]
    ends = covered & np.r_[~covered[1:] | (owner[1:] != owner[:-1]), True]
    run_of, run_a, run_b = owner[begins], within[begins], within[ends] + WINDOW
    later = np.flatnonzero(ids > earliest[content])
    own = np.flatnonzero(ids == earliest[content])
    runs = np.bincount(run_of, minlength=n_contents)
    first_run = np.cumsum(runs) - runs
    n = runs[content[own]]
    member = np.repeat(own, n)
    run = np.repeat(first_run[content[own]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    who = np.concatenate([later, member])
    a = starts[who] + np.concatenate([np.zeros(len(later), dtype=np.int64), run_a[run]])
    b = starts[who] + np.concatenate([sizes[content[later]] + WINDOW - 1, run_b[run]])
    return _by_document(ids[who], texts[who], a, b)


def _by_document(ids: np.ndarray, texts: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((b, a, texts, ids))
    ids, texts, a, b = ids[order], texts[order], a[order], b[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1])][: len(ids)]
    # Spans that touch the one before are one; rows that repeat an id and a text add nothing.
    reach = np.zeros(0, dtype=np.int64)
    if len(a):
        cut = np.flatnonzero(new)
        reach = np.concatenate([np.maximum.accumulate(part) for part in np.split(b, cut[1:])])
    fresh = np.r_[True, new[1:] | (a[1:] > reach[:-1])][: len(ids)]
    begin = np.flatnonzero(fresh)
    pairs = np.stack([a[begin], reach[np.append(begin[1:], len(a)) - 1]], axis=1).astype("<i4") if len(a) else np.zeros((0, 2), "<i4")
    cuts = np.flatnonzero(new[begin]) if len(a) else begin
    return pd.DataFrame(
        {
            "doc_id": ids[begin[cuts]],
            "text_hash": texts[begin[cuts]],
            "spans": [part.tobytes() for part in np.split(pairs, cuts[1:])][: len(cuts)],
        }
    )


def _parsed(texts: DataFrame, blocks: int, crowded: np.ndarray) -> DataFrame:
    """``_SPANS`` rows of all stretches but those of crowded hashes, by parsing block by block."""
    shared = texts.sparkSession.sparkContext.broadcast(crowded)

    @tidy
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for ids, text_hashes, found in _batches(frames, hashes, BATCH_WORDS):
            chosen = np.flatnonzero(~np.isin(found.anchor, shared.value))
            if len(chosen):
                yield pd.DataFrame(list(_packed(ids, text_hashes, found, chosen, blocks)))

    packed = texts.mapInPandas(pack, _PACKED)
    return packed.groupBy("block").applyInPandas(_block_spans, _SPANS)


def _crowded(texts: DataFrame, crowded: np.ndarray) -> DataFrame:
    """``_SPANS`` rows of the stretches of crowded hashes, window by window."""
    shared = texts.sparkSession.sparkContext.broadcast(crowded)

    @tidy
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for ids, text_hashes, found in _batches(frames, hashes, BATCH_WORDS):
            chosen = np.flatnonzero(np.isin(found.anchor, shared.value))
            if len(chosen):
                places, sizes = found.window_places(chosen), found.sizes[chosen]
                doc = np.repeat(found.doc[chosen], sizes)
                step = np.arange(len(places)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pd.DataFrame(
                    {
                        "window": found.windows[places].view(np.int64),
                        "doc_id": ids[doc],
                        "text_hash": text_hashes[doc],
                        "at": np.repeat(found.start[chosen], sizes) + step,
                    }
                )

    def join_spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["at"].map(len).to_numpy()
            at = np.concatenate(frame["at"].to_list()) if len(frame) else np.zeros(0, dtype=np.int64)
            yield _by_document(
                np.repeat(frame["doc_id"].to_numpy(), sizes),
                np.repeat(frame["text_hash"].to_numpy(), sizes),
                at,
                at + WINDOW,
            )

    places = written(texts.mapInPandas(cut, "window long, doc_id long, text_hash long, at long"))
    firsts = places.groupBy("window").agg(
        F.min("doc_id").alias("earliest"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )
    firsts = written(firsts.where("earliest < last").drop("last"))
    repeats = lookup_join(places, firsts, "window", "n").where(F.col("doc_id") > F.col("earliest"))
    found = repeats.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("at"))
    return found.mapInPandas(join_spans, _SPANS)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, spans)`` of ``(doc_id, text)``: words ``from`` to before ``to``, from 0, to remove.

    One row per id and text with any span.  ``text_hash`` is the ``xxhash64`` of the text, ``spans`` holds binary arrays of
    pairs of little-endian 32-bit numbers, which may overlap.
    """
    texts = _rows(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
    windows, crowds = _crowds(texts)
    # Bounded, see _crowds.
    crowded = np.array([row["anchor"] for row in crowds.collect()], dtype=np.int64).view(np.uint64)
    spans = _parsed(texts, max(1, -(-windows // BLOCK_WINDOWS)), crowded)
    if len(crowded):
        spans = spans.unionByName(_crowded(texts, crowded))
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_list("spans").alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of ``(doc_id, text)``, a row for each row.

    A word goes if a window over it also starts in a document of smaller id; windows are judged on
    the input.  ``kept`` are the other words, joined by one space.
    """

    @tidy
    def strip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts, removed, kept = [], [], []
            for text, spans in zip(frame["text"], frame["spans"], strict=True):
                words = WORDS.findall(text) if text is not None else []
                counts.append(len(words))
                if spans is not None and len(spans):
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    pairs = np.frombuffer(b"".join(spans), "<i4").reshape(-1, 2)
                    np.add.at(change, pairs[:, 0], 1)
                    np.add.at(change, pairs[:, 1], -1)
                    stays = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                    words = [words[at] for at in stays]
                removed.append(counts[-1] - len(words))
                kept.append(" ".join(words))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "n_words": counts, "n_removed": removed, "kept": kept}
            )

    keys = ["doc_id", "text_hash"]
    # Spans are the smaller side by far; no sort of whole texts is needed to meet them.
    joined = _rows(docs).join(repeated_spans(docs).hint("shuffle_hash"), keys, "left")
    return joined.select("doc_id", "text", "spans").mapInPandas(
        strip, "doc_id long, n_words long, n_removed long, kept string"
    )
