"""Token ids in directly addressable codes.

An id is split into chunks, low bits first.  Level 0 holds the first chunk of every id; a
bitmap says which ids go on, and level 1 holds the next chunk of those, and so forth.  The
place of an id on the next level is the number of set bits before it, which a directory of
ranks per 64-bit word answers with one lookup and one bit count.  So any id is read by
itself: nothing before it is decoded.

Segment, little-endian: ``MAGIC``, level count, number of ids, then per level its width in
bytes, its length, and its chunks; every level but the last is followed by its bitmap in
64-bit words and by the rank before each word.

Texts are ordered by id over range partitions, and each task writes segments of whole documents.
Null and empty texts hold the end id only; rows with equal ids stay separate rows, ordered by
a hash of their text, then by their number in the input.  A text of any length is encoded whole, in one segment, which may so be
longer than others.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termweave.llm.bpe import UNSPLIT, byte_letters, words_of
from termweave.llm.common import Memo, once, shared_folder, tidy

MAGIC = b"DAC1"
WIDTHS = (1, 1, 2)
END_ID = 1
SEGMENT_IDS = 1 << 20
# Words, and pieces of texts, that an encoder remembers.  Beyond so many pieces it begins anew; frequent ones are soon back.
KEPT = 250_000
# Texts that are encoded together, by letters.
TOGETHER = 1 << 20

SEGMENTS = (
    "part int, seq int, start_in_part long, n_ids long,"
    " doc_ids array<long>, doc_sizes array<int>, payload binary"
)


def encode(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """One segment of unsigned ids below ``256 ** sum(widths)``."""
    rest = np.asarray(ids, dtype=np.uint64)
    if len(rest) and int(rest.max()) >> (8 * sum(widths)):
        raise ValueError("an id does not fit the levels")
    out = [MAGIC, struct.pack("<IQ", len(widths), len(rest))]
    for level, width in enumerate(widths):
        kind = {1: "<u1", 2: "<u2", 4: "<u4"}[width]
        out.append(struct.pack("<BQ", width, len(rest)))
        out.append((rest & np.uint64((1 << (8 * width)) - 1)).astype(kind).tobytes())
        if level + 1 < len(widths):
            rest = rest >> np.uint64(8 * width)
            more = rest > 0
            words = _words(more)
            ranks = np.zeros(len(words), dtype="<u8")
            np.cumsum(np.bitwise_count(words)[:-1], out=ranks[1:], dtype=np.uint64)
            out += [words.tobytes(), ranks.tobytes()]
            rest = rest[more]
    return b"".join(out)


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, bitorder="little")
    padded = np.zeros(-(-len(bits) // 64) * 8 or 8, dtype=np.uint8)
    padded[: len(packed)] = packed
    return padded.view("<u8")


class Segment:
    """Random access to the ids of one encoded segment."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        levels, self.size = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for level in range(levels):
            width, n = struct.unpack_from("<BQ", data, at)
            at += 9
            chunks = np.frombuffer(data, {1: "<u1", 2: "<u2", 4: "<u4"}[width], n, at)
            at += width * n
            words = ranks = None
            if level + 1 < levels:
                k = -(-n // 64) or 1
                words = np.frombuffer(data, "<u8", k, at)
                ranks = np.frombuffer(data, "<u8", k, at + 8 * k)
                at += 16 * k
            self.levels.append((width, chunks, words, ranks))

    def __len__(self) -> int:
        return self.size

    def access(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions, in any order."""
        at = np.asarray(positions, dtype=np.uint64)
        found = np.zeros(len(at), dtype=np.uint32)
        where, shift = None, 0
        for width, chunks, words, ranks in self.levels:
            part = chunks[at].astype(np.uint32) << np.uint32(shift)
            if where is None:
                found |= part
            else:
                found[where] |= part
            if words is None or not len(at):
                break
            word, bit = at >> np.uint64(6), at & np.uint64(63)
            held = words[word]
            more = (held >> bit) & np.uint64(1) == 1
            lower = held & ((np.uint64(1) << bit) - np.uint64(1))
            following = ranks[word] + np.bitwise_count(lower)
            at = following[more]
            where = np.flatnonzero(more) if where is None else where[more]
            shift += 8 * width
        return found

    def __getitem__(self, position: int) -> int:
        if not 0 <= position < self.size:
            raise IndexError(position)
        return int(self.access(np.array([position]))[0])


class Encoder:
    """Ids of whole texts as 32-bit numbers, by the tokenizers library.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its pieces between white
    space, and a piece's are those of its words.  Words go to the library's model one by one, frequent ones once.  A piece
    is numbered, and the ids of all pieces are kept one after the other; a text is a gathering of them.  Texts
    with controls that Python cuts at, or with special tokens, are encoded by the library as they are.
    """

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join(map(re.escape, (*UNSPLIT, *special))))
        model, letters = self.tokenizer.model, byte_letters()

        def ids_of(word: str) -> bytes:
            if not (word.isascii() and word.isalnum()):
                word = "".join(letters[byte] for byte in word.encode())
            return array("I", [token.id for token in model.tokenize(word)]).tobytes()

        self.words = Memo(ids_of, KEPT)
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.starts = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def _learn(self, pieces: list[str]) -> None:
        """Add the ids of pieces that are numbered, but not yet encoded."""
        word = self.words.__getitem__
        found = [
            word(piece.lower()) if piece.isascii() and piece.isalpha() else b"".join(map(word, words_of(piece)))
            for piece in pieces
        ]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def gather(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each."""
        if len(self.numbers) > KEPT:
            self._forget()
        alone = [i for i, text in enumerate(texts) if text and self.whole.search(text)]
        cut = [(text or "").split() for text in texts]
        for i in alone:
            cut[i] = []
        known = len(self.numbers)
        number = self.numbers.__getitem__
        n_pieces = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(number, chain.from_iterable(cut)), np.int64, int(n_pieces.sum()))
        self._learn(list(islice(self.numbers, known, None)))
        begin, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))]
        counts = np.diff(np.concatenate([[0], ends])[np.cumsum(np.append(0, n_pieces))])
        if not alone:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in alone:
            found = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
            parts[i] = np.array(found, dtype="<u4")
        return np.concatenate(parts), np.array([len(part) for part in parts])

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        ids, counts = self.gather(texts)
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]


class _Numbers(dict):
    """A number for each string, in the order they are met."""

    def __missing__(self, key: str) -> int:
        at = self[key] = len(self)
        return at


def _slices(batch: pd.DataFrame) -> Iterator[tuple[list, list]]:
    """Ids and texts of a batch, about ``TOGETHER`` letters at a time."""
    ids, texts, letters = [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
        ids.append(None if pd.isna(doc_id) else int(doc_id))
        texts.append(text)
        letters += len(text or "")
        if letters >= TOGETHER:
            yield ids, texts
            ids, texts, letters = [], [], 0
    if ids:
        yield ids, texts


def _segment(part: int, seq: int, start: int, doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> dict:
    return {
        "part": part,
        "seq": seq,
        "start_in_part": start,
        "n_ids": len(ids),
        "doc_ids": doc_ids,
        "doc_sizes": sizes,
        "payload": encode(ids),
    }


def write_ids(
    docs: DataFrame, tokenizer_json: str, path: str, segment_ids: int = SEGMENT_IDS
) -> None:
    """Encode ``(doc_id, text)`` and write segments in ascending order of ids below ``path``."""
    context = docs.sparkSession.sparkContext
    # One file of a public tokenizer, a few MB whatever the data.
    model = context.broadcast(tokenizer_json)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Kept for later tasks: most of what a task learns are words that all texts have.
        encoder = once(("dac", hash(model.value)), lambda: Encoder(model.value))
        doc_ids, sizes, pieces, held, seq, start, part = [], [], [], 0, 0, 0, 0

        def segment() -> pd.DataFrame:
            row = _segment(part, seq, start, doc_ids, np.concatenate(sizes), np.concatenate(pieces))
            return pd.DataFrame([row])

        for batch in batches:
            part = int(batch["part"].iloc[0]) if len(batch) else part
            for listed, texts in _slices(batch):
                ids, counts = encoder.gather(texts)
                ends = np.cumsum(counts + 1)
                # Whole documents go to a segment until it is full.
                first = 0
                while first < len(listed):
                    full = np.searchsorted(ends, (ends[first - 1] if first else 0) + segment_ids - held)
                    last = min(len(listed), int(full) + 1)
                    with_end = np.insert(
                        ids[ends[first - 1] - first if first else 0 : ends[last - 1] - last],
                        np.cumsum(counts[first:last]),
                        np.uint32(END_ID),
                    )
                    doc_ids += listed[first:last]
                    sizes.append(counts[first:last] + 1)
                    pieces.append(with_end)
                    held += len(with_end)
                    first = last
                    if held >= segment_ids:
                        yield segment()
                        seq, start = seq + 1, start + held
                        doc_ids, sizes, pieces, held = [], [], [], 0
        if doc_ids:
            yield segment()

    # Any number of rows may be equal in id and text; their number in the input tells them apart.
    ties = F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")
    ranged = (
        docs.select("doc_id", "text", *ties)
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    ranged.mapInPandas(encoded, SEGMENTS).write.parquet(path)


def read_ids(segments: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of written segments.

    Offsets inside a partition are in the segments; what is before a partition is a sum over
    one row per partition, which is all that is broadcast.
    """
    before = (
        segments.groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
        .select(
            "part",
            F.coalesce(
                F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("before"),
        )
    )
    placed = segments.join(F.broadcast(before), "part").select(
        (F.col("before") + F.col("start_in_part")).alias("start"), "doc_ids", "doc_sizes", "payload"
    )

    @tidy
    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, doc_ids, sizes, payload in batch.itertuples(index=False):
                segment = Segment(payload)
                ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
                begins = ends - sizes
                held = segment.access(np.arange(len(segment))).astype("<u4")
                crcs = [zlib.crc32(held[a:b]) for a, b in zip(begins, ends, strict=True)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(doc_ids, dtype="Int64"),
                        "start": start + begins,
                        "n_tokens": np.asarray(sizes, dtype=np.int64),
                        "ids_crc32": np.asarray(crcs, dtype=np.int64),
                    }
                )

    return placed.mapInPandas(decoded, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_counts(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """``(doc_id, n_tokens)`` of ``(doc_id, text)``, without end ids; 0 for null and empty texts."""
    # One file of a public tokenizer, a few MB whatever the data.
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = once(("dac", hash(model.value)), lambda: Encoder(model.value))
        for batch in batches:
            for ids, texts in _slices(batch):
                _, counts = encoder.gather(texts)
                yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "n_tokens": counts})

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInPandas(counted, "doc_id long, n_tokens long")


def encode_documents(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Write the ids of ``(doc_id, text)`` to the shared folder and report what the files hold."""
    spark = docs.sparkSession
    path = shared_folder(spark)
    write_ids(docs, tokenizer_json, path)
    return read_ids(spark.read.schema(SEGMENTS).parquet(path))
