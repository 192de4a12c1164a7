"""BPE encoding by backtracking, and decoding by an offset table.

``Table`` holds a tokenizer file of the word-end kind: merges, ranks, and which tokens are
reachable.  To encode a word, one pass of an Aho-Corasick automaton over its reversed symbols
gives the longest token that starts at each place.  The encoder takes these from left to right.
A token may follow another only if merging them could not have begun across their border, which
is looked up, or found by undoing merges and kept.  Where no token fits, it goes back by one
token and marks the place as dead; as places die once, work is linear in the word, and the
result is exactly that of merging by rank.

Null texts count as empty; both have no ids and decode to the empty text.  Texts of any length are encoded whole and decoded in
parts.  Rows that repeat are coded each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from termweave.llm.common import Memo, once

KEPT_CHUNKS = 300_000
KEPT_WORDS = 300_000
KEPT_PAIRS = 500_000
DECODED_IDS = 1 << 18
# Python splits at these controls, the tokenizer does not.
UNSPLIT = ("\x1c", "\x1d", "\x1e", "\x1f")
# Fixed value: the pattern of words that the tokenizer file states.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def words_of(text: str) -> list[str]:
    """The words that are encoded one by one, as the tokenizer file normalises and cuts a text."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # its lower case depends on its neighbours
            return WORDS.findall("".join(map(str.lower, text)))
    return WORDS.findall(text.lower())


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Table:
    """Merges of a tokenizer, by internal number: symbols first, then merges by rank."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        # Symbols as single letters: a byte, or a byte that ends a word.
        texts = letters + [letter + suffix for letter in letters]
        self.strings = [chr(at) for at in range(512)]
        self.left, self.right = list(range(512)), list(range(512))
        number = {text: at for at, text in enumerate(texts)}
        self.pairs: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = (number[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            at = number.setdefault(texts[a] + texts[b], len(texts))
            if at == len(texts):
                texts.append(texts[a] + texts[b])
                self.strings.append(self.strings[a] + self.strings[b])
                self.left.append(a)
                self.right.append(b)
            self.pairs.setdefault((a, b), at)
        self.ids = [vocab[text] for text in texts]
        self.lengths = [len(s) for s in self.strings]
        self.fits: dict[int, bool] = {}
        known = {s: at for at, s in enumerate(self.strings)}
        # A token that merging never makes of its own letters must not be matched.
        self.shorter = [-1] * len(texts)
        reachable = dict.fromkeys(range(512))
        for at in range(512, len(texts)):
            if self._fits((self.left[at], self.right[at]), at):
                reachable[at] = None
        self.automaton = ahocorasick.Automaton()
        for at in reachable:
            self.automaton.add_word(self.strings[at][::-1], at)
        self.automaton.make_automaton()
        for at in reachable:
            s = self.strings[at]
            for end in range(len(s) - 1, 0, -1):
                if (prefix := known.get(s[:end], -1)) in reachable:
                    self.shorter[at] = prefix
                    break
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.marks = {text[0] for text in self.special}
        names = {i: text for text, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pieces = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.offsets = np.cumsum([0, *map(len, pieces)])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def _fits(self, pair: tuple[int, int], limit: int | None = None) -> bool:
        """Whether the second token stays apart from the first when both texts are merged.

        Undo the later of the two tokens' merges, again and again: if the pair at the border could
        merge before that merge was made, it would have.
        """
        a, b = pair
        limit = len(self.left) if limit is None else limit
        while True:
            if self.pairs.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, self.right[a]
                if a == limit:
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        return True

    def word(self, symbols: str) -> list[int]:
        """Internal numbers of the tokens of one word, given as symbols."""
        n = len(symbols)
        longest = [0] * n
        for end, at in self.automaton.iter(symbols[::-1]):
            start = n - 1 - end
            if self.lengths[at] > self.lengths[longest[start]] or not longest[start]:
                longest[start] = at
        alive, tokens, place = bytearray(b"\1") * (n + 1), [], 0
        lengths, fits, token, previous = self.lengths, self.fits, longest[0] if n else 0, -1
        while place < n:
            end = place + lengths[token]
            if alive[end]:
                if previous < 0:
                    fit = True
                elif (fit := fits.get(previous << 20 | token)) is None:
                    fit = self._fits((previous, token))
                    if len(fits) < KEPT_PAIRS:
                        fits[previous << 20 | token] = fit
                if fit:
                    tokens.append(token)
                    previous, place = token, end
                    if end < n:
                        token = longest[end]
                    continue
            if (shorter := self.shorter[token]) >= 0:
                token = shorter
            else:
                alive[place] = 0
                token = tokens.pop()
                place -= lengths[token]
                previous = tokens[-1] if tokens else -1
        return tokens


class Codec:
    """Encode texts to ids as little-endian 32-bit numbers, and ids to text."""

    def __init__(self, tokenizer_json: str):
        self.table = Table(tokenizer_json)
        self.words = Memo(self._word, KEPT_WORDS)
        self.chunks = Memo(self._chunk, KEPT_CHUNKS)

    def _word(self, word: str) -> bytes:
        data = word.encode()
        symbols = data[:-1].decode("latin-1") + chr(256 + data[-1])
        ids = self.table.ids
        return array("I", [ids[at] for at in self.table.word(symbols)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, words_of(text)))

    def _chunk(self, text: str) -> bytes:
        if self.table.marks.isdisjoint(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.table.specials.finditer(text):
            out.append(self._plain(text[at : found.start()]))
            out.append(array("I", [self.table.special[found[0]]]).tobytes())
            at = found.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(control in text for control in UNSPLIT):
            return self._chunk(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """The tokens' texts with a space between them, in parts of bounded size."""
        offsets, data = self.table.offsets, self.table.bytes
        for at in range(0, len(ids), DECODED_IDS):
            part = ids[at : at + DECODED_IDS]
            begins = offsets[part]
            sizes = offsets[part + 1] - begins
            shift = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
            text = data[shift + np.arange(len(shift))].tobytes()
            yield text[:-1] if at + DECODED_IDS >= len(ids) else text


def round_trip(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of ``(doc_id, text)``."""
    # One file of a public tokenizer, a few MB whatever the data.
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = once(("bpe", hash(model.value)), lambda: Codec(model.value))
        for batch in batches:
            rows = []
            for text in batch["text"]:
                data = codec.encode(text)
                decoded = hashlib.sha256()
                for part in codec.decode(np.frombuffer(data, "<u4")):
                    decoded.update(part)
                rows.append((len(data) // 4, hashlib.sha256(data).hexdigest(), decoded.hexdigest()))
            n, ids, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": pd.Series(n, dtype="int64"),
                    "ids_sha256": pd.Series(ids, dtype="str"),
                    "decoded_sha256": pd.Series(texts, dtype="str"),
                }
            )

    return docs.select("doc_id", "text").mapInPandas(
        coded, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
