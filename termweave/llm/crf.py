"""Language ID of words in code-switched text by a linear-chain conditional random field.

A word's emission is a sum over hashed features (beginnings, ends, character n-grams, the
word) and over a lexicon of words that the training sample shows in one language. Transitions are
learned with the rest. Forward-backward gives each word's language probabilities given its
whole text; a document's language is the one with most probability over its words.

The fit sees a bounded sample: about ``DOCS_PER_LANGUAGE`` rows a language, at most twice as many, picked by a hash of
id and text, and of each a window of ``WINDOW`` words that starts at a place the hash picks.  Training
sequences are pieces of such windows, and go on in another language at the rate ``SWITCHES``, so that
transitions between languages are seen.  Every text is labelled whole.

Texts of a batch are joined to one chain; where a text begins, the transition forgets the text
before.  The chain is cut into about sqrt(n) blocks, whose transfer matrices are multiplied up
side by side, so the work is that of the plain recursion, in long vectors.

The ``LANGUAGES`` most frequent languages are learned.  Null texts and texts without letters are ``und`` with score 0.  Rows that
repeat are labelled each.  Of languages that fit alike the first by name is taken.
Without any labelled row all texts are ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import fraction, tidy, unused

DOCS_PER_LANGUAGE = 500
# The most frequent languages, which are learned.
LANGUAGES = 256
WINDOW = 150
SWITCHES = 0.15
PIECE = 12
SEQUENCE = 48
BITS = 15
LEXICON_LEAST = 3
LEXICON_SHARE = 0.8
# Words and pieces of text that a task remembers before it starts anew.
KEPT_WORDS = 150_000
KEPT_PIECES = 200_000
# Letters that a task labels at a time: a word takes about a dozen arrays of its probabilities meanwhile.
TOGETHER = 1 << 18
UNDETERMINED = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(4)) == 2


def letters(word: str) -> str:
    """The lower-cased letters of a piece of text between white space."""
    return word.lower() if word.isalpha() else NOT_LETTERS.sub("", word.lower())


def features(word: str) -> list[int]:
    """Hashed affix, n-gram and word features of lower-cased letters."""
    framed = f"^{word}$"
    names = [framed]
    for n in (1, 2, 3):
        names += ["<" + word[:n], ">" + word[-n:]]
    names += [framed[at : at + n] for n in (2, 3) for at in range(len(framed) - n + 1)]
    mask = (1 << BITS) - 1
    return [zlib.crc32(name.encode()) & mask for name in names]


def trigrams(word: str) -> list[str]:
    framed = f"^{word}$"
    return [framed[at : at + 3] for at in range(max(1, len(framed) - 2))]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # feature x language, hashed features first, then one per lexicon language
    transitions: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int]
    trigrams: frozenset[str] = frozenset()  # of the sample's words

    def familiarity(self, words: list[str]) -> np.ndarray:
        """The share of each word's trigrams that the sample has."""
        grams = [trigrams(word) for word in words]
        return np.array([sum(g in self.trigrams for g in own) / len(own) for own in grams])

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log-potentials of words, which have letters."""
        rows = [features(word) for word in words]
        sizes = np.array([len(row) for row in rows])
        flat = np.fromiter((f for row in rows for f in row), np.int64, sizes.sum())
        sums = np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0)
        entries = np.array([self.lexicon.get(word, -1) for word in words])
        out = sums / sizes[:, None]
        out[entries >= 0] += self.weights[(1 << BITS) + entries[entries >= 0]]
        return out


def marginals(
    emissions: np.ndarray, begins: np.ndarray, transitions: np.ndarray, start: np.ndarray
) -> np.ndarray:
    """Probabilities of each label at each place of chains that are joined to one.

    ``emissions`` are log-potentials, ``begins`` says where a chain starts.
    """
    n, k = emissions.shape
    if not n:
        return np.zeros((0, k))
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    e = np.ones((blocks * width, k))
    e[:n] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    first = np.ones(blocks * width, dtype=bool)
    first[:n] = begins
    first[0] = True
    # Place-major: step t of all blocks lies together.
    e = np.ascontiguousarray(e.reshape(blocks, width, k).transpose(1, 0, 2))
    first = np.ascontiguousarray(first.reshape(blocks, width).T)
    step = np.exp(transitions - transitions.max())
    begin = np.exp(start - start.max())

    def forward(state: np.ndarray, t: int) -> np.ndarray:
        """Row vectors, one or k per block, moved over place t."""
        moved = state @ step
        anew = state.sum(axis=-1, keepdims=True) * begin
        fresh = first[t].reshape(-1, *[1] * (state.ndim - 1))
        moved = np.where(fresh, anew, moved) * (e[t] if state.ndim == 2 else e[t][:, None, :])
        axes = tuple(range(1, state.ndim))
        return moved / moved.sum(axis=axes, keepdims=True)

    transfer = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(width):
        transfer = forward(transfer, t)
    entry = np.empty((blocks, k))
    state = np.full(k, 1.0 / k)
    for b in range(blocks):
        entry[b] = state
        state = state @ transfer[b]
        state = state / state.sum()
    leave = np.empty((blocks, k))
    state = np.full(k, 1.0 / k)
    for b in reversed(range(blocks)):
        leave[b] = state
        state = transfer[b] @ state
        state = state / state.sum()
    alpha = np.empty((width, blocks, k))
    state = entry
    for t in range(width):
        alpha[t] = state = forward(state, t)
    state = leave
    for t in reversed(range(width)):
        alpha[t] *= state
        weighted = state * e[t]
        back = weighted @ step.T
        anew = np.broadcast_to((weighted @ begin)[:, None], back.shape)
        state = np.where(first[t][:, None], anew, back)
        state = state / state.sum(axis=1, keepdims=True)
    found = alpha.transpose(1, 0, 2).reshape(-1, k)[:n]
    return found / found.sum(axis=1, keepdims=True)


def _sequences(windows: dict[int, list[list[str]]], rng) -> list[tuple[list[str], list[int]]]:
    """Training chains: pieces of windows, going on in another language now and then."""
    pieces = [
        (label, window[at : at + PIECE])
        for label, texts in windows.items()
        for window in texts
        for at in range(0, len(window), PIECE)
    ]
    if not pieces:
        return []
    by_label: dict[int, list[list[str]]] = {}
    for label, piece in pieces:
        by_label.setdefault(label, []).append(piece)
    labels = sorted(by_label)
    out = []
    for label, piece in pieces:
        words, marks = list(piece), [label] * len(piece)
        now = label
        while len(words) < SEQUENCE:
            if rng.random() < SWITCHES and len(labels) > 1:
                now = labels[rng.integers(len(labels))]
            more = by_label[now][rng.integers(len(by_label[now]))]
            cut = more[: 1 + rng.integers(len(more))] if rng.random() < SWITCHES else more
            words += cut
            marks += [now] * len(cut)
        out.append((words[:SEQUENCE], marks[:SEQUENCE]))
    return [out[i] for i in rng.permutation(len(out))]


def fit(texts: list[tuple[str, list[str]]], epochs: int = 4, batch: int = 128) -> Model | None:
    """A model from ``(language, words)``, by Adam on the likelihood of whole chains."""
    languages = tuple(sorted({language for language, words in texts if words}))
    if not languages:
        return None
    k, number = len(languages), {language: at for at, language in enumerate(languages)}
    rng = np.random.default_rng(7)
    windows: dict[int, list[list[str]]] = {}
    counts: list[Counter] = [Counter() for _ in languages]
    for language, words in sorted(texts):
        if words:
            windows.setdefault(number[language], []).append(words)
            counts[number[language]].update(words)
    totals = [max(1, sum(c.values())) for c in counts]
    lexicon = {}
    for word in sorted(set().union(*counts)):
        seen = [c[word] / t for c, t in zip(counts, totals, strict=True)]
        top = int(np.argmax(seen))
        if counts[top][word] >= LEXICON_LEAST and seen[top] >= LEXICON_SHARE * sum(seen):
            lexicon[word] = top
    chains = _sequences(windows, rng)
    vocabulary = {w: at for at, w in enumerate(sorted({w for words, _ in chains for w in words}))}
    rows = [features(word) for word in vocabulary]
    size = (1 << BITS) + k
    sizes = np.array([len(row) for row in rows])
    flat = np.array([f for row in rows for f in row])
    starts = np.cumsum(sizes) - sizes
    entry = np.array([lexicon.get(word, -1) for word in vocabulary])
    xs = np.array([[vocabulary[w] for w in words] for words, _ in chains])
    ys = np.array([marks for _, marks in chains])
    w, t, s = np.zeros((size, k)), np.zeros((k, k)), np.zeros(k)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, t, s)]
    onehot = np.eye(k)
    updates = 0
    for _ in range(epochs):
        for at in range(0, len(xs), batch):
            x, y = xs[at : at + batch], ys[at : at + batch]
            n = len(x)
            met, place = np.unique(x, return_inverse=True)
            place = place.reshape(x.shape)
            width = sizes[met]
            owner = np.repeat(np.arange(len(met)), width)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)
            cols = flat[np.repeat(starts[met], width) + inside]
            emission = np.zeros((len(met), k))
            for label in range(k):
                emission[:, label] = np.bincount(owner, w[cols, label], len(met)) / width
            known = entry[met] >= 0
            emission[known] += w[(1 << BITS) + entry[met][known]]
            e = emission[place]
            e = np.exp(e - e.max(axis=2, keepdims=True))
            step, begin = np.exp(t), np.exp(s)
            alpha, beta = np.empty_like(e), np.empty_like(e)
            state = begin * e[:, 0]
            alpha[:, 0] = state = state / state.sum(axis=1, keepdims=True)
            for j in range(1, SEQUENCE):
                state = (state @ step) * e[:, j]
                alpha[:, j] = state = state / state.sum(axis=1, keepdims=True)
            beta[:, -1] = state = np.full((n, k), 1.0 / k)
            for j in range(SEQUENCE - 2, -1, -1):
                state = (state * e[:, j + 1]) @ step.T
                beta[:, j] = state = state / state.sum(axis=1, keepdims=True)
            unary = alpha * beta
            unary /= unary.sum(axis=2, keepdims=True)
            pair = alpha[:, :-1, :, None] * step * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            wrong = unary - onehot[y]
            g_t = pair.sum(axis=(0, 1))
            np.subtract.at(g_t, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
            g_s = wrong[:, 0].sum(axis=0)
            g_e = np.zeros((len(met), k))
            for label in range(k):
                g_e[:, label] = np.bincount(place.ravel(), wrong[..., label].ravel(), len(met))
            spread = (g_e / width[:, None])[owner]
            g_w = np.zeros_like(w)
            for label in range(k):
                g_w[:, label] = np.bincount(cols, spread[:, label], size)
            np.add.at(g_w, (1 << BITS) + entry[met][known], g_e[known])
            updates += 1
            for param, grad, rate, (m, v) in zip(
                (w, t, s), (g_w, g_t, g_s), (0.1, 0.05, 0.05), moments, strict=True
            ):
                grad = grad / n + 1e-4 * param
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad**2
                param -= rate * (m / (1 - 0.9**updates)) / (np.sqrt(v / (1 - 0.99**updates)) + 1e-8)
    seen = frozenset(gram for word in vocabulary for gram in trigrams(word))
    return Model(languages, w, t, s, lexicon, seen)


def train(docs: DataFrame) -> Model | None:
    """Fit on a bounded sample of ``(doc_id, text, lang)``, without held-out rows."""
    usable = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    counts = sizes.collect()
    share, by = F.lit(0.0), ("doc_id", F.xxhash64("text"))
    for row in counts:
        share = F.when(
            F.col("lang") == row["lang"], F.lit(DOCS_PER_LANGUAGE / row["count"])
        ).otherwise(share)
    words = F.split(F.trim("text"), r"\s+")
    begin = F.floor(fraction("doc_id", F.lit(1)) * F.greatest(F.lit(1), F.size("words") - WINDOW))
    sample = (
        usable.where(fraction(*by) < share)
        .orderBy(fraction(*by))
        .limit(2 * DOCS_PER_LANGUAGE * max(1, len(counts)))  # ids and texts that repeat share their number
        .select("doc_id", "lang", words.alias("words"))
        .where("words IS NOT NULL")
        .select("lang", F.slice("words", (begin + 1).cast("int"), F.lit(WINDOW)).alias("words"))
    )
    return fit(
        [(row["lang"], [w for w in map(letters, row["words"]) if w]) for row in sample.collect()]
    )


class Labeller:
    """Applies a model to lists of texts and keeps the emissions of frequent words."""

    def __init__(self, model: Model):
        self.model = model
        k = len(model.languages)
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, k + 1))  # emissions, and familiarity
        self.words: dict[str, int] = {"": 0}
        self.used = 1

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        while self.used + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        place = slice(self.used, self.used + len(words))
        self.table[place, :-1] = self.model.emissions(words)
        self.table[place, -1] = self.model.familiarity(words)
        self.words.update(zip(words, range(self.used, self.used + len(words)), strict=True))
        self.used += len(words)

    def lookup(self, texts: list[str | None]) -> list[np.ndarray]:
        """Rows of ``table`` for the words of each text that have letters."""
        if self.used > KEPT_WORDS or len(self.rows) > KEPT_PIECES:
            self.rows, self.words, self.used = {}, {"": 0}, 1
        cut = [(text or "").split() for text in texts]
        new = {piece for piece in set().union(*cut) if piece not in self.rows}
        words = {piece: letters(piece) for piece in new}
        self._learn(sorted(word for word in set(words.values()) if word not in self.words))
        self.rows.update((piece, self.words[word]) for piece, word in words.items())
        row = self.rows.__getitem__
        found = [np.fromiter(map(row, pieces), np.int64, len(pieces)) for pieces in cut]
        return [rows[rows > 0] for rows in found]

    def label(self, texts: list[str | None]) -> list[np.ndarray]:
        """Language probabilities of the words with letters of each text."""
        return self.judge(texts)[0]

    def judge(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[float]]:
        """As ``label``, and how familiar the words of each text are on average, from 0 to 1."""
        rows = self.lookup(texts)
        familiar = [float(self.table[own, -1].mean()) if len(own) else 0.0 for own in rows]
        sizes = np.array([len(r) for r in rows])
        ends = np.cumsum(sizes)
        flat = np.concatenate(rows) if len(rows) else np.zeros(0, dtype=np.int64)
        begins = np.zeros(len(flat), dtype=bool)
        begins[(ends - sizes)[sizes > 0]] = True
        found = marginals(self.table[flat, :-1], begins, self.model.transitions, self.model.start)
        return (np.split(found, ends[:-1]) if len(rows) else []), familiar


def _slices(texts: pd.Series) -> Iterator[list[str | None]]:
    """The texts, about ``TOGETHER`` letters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _verdict(model: Model, probabilities: np.ndarray) -> tuple[str, float]:
    if not len(probabilities):
        return UNDETERMINED, 0.0
    mean = probabilities.mean(axis=0)
    top = int(np.argmax(mean))
    return model.languages[top], float(min(1.0, max(0.0, mean[top])))


def languages(docs: DataFrame, model: Model | None):
    """A function of a text column: ``struct(lang_pred, score, familiar)``."""
    # Bounded: 2 ** BITS rows of weights and the words of the sample.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, familiar double")
    @tidy
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        labeller = None if model is None else Labeller(model)
        for texts in batches:
            found = []
            for held in _slices(texts):
                if labeller:
                    labelled, familiar = labeller.judge(held)
                    found += [(*_verdict(model, p), f) for p, f in zip(labelled, familiar, strict=True)]
                else:  # all with letters are as familiar as can be
                    worded = (any(map(letters, (text or "").split())) for text in held)
                    found += [(UNDETERMINED, 0.0, float(fits)) for fits in worded]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "familiar"])

    return detect


def detect_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of ``(doc_id, text, lang)``."""
    detect = languages(docs, train(docs))
    found = docs.select("doc_id", detect("text").alias("found"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score"
    )


def keep_determined(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose words are familiar, by ``least`` of their trigrams on average, with all their columns.

    Texts in several learned languages stay, and all with letters where no language was learned; texts in other scripts or
    languages unlike all learned ones, and texts without letters, go.  Where ``lang`` is null it becomes the text's
    language; all else is as it was.  Rows that repeat are judged each.
    """
    found = unused(docs, "_found")
    # Not to be run a second time for the filter.
    detect = languages(docs, train(docs)).asNondeterministic()
    judged = docs.withColumn(found, detect("text"))
    kept = judged.where(F.col(found)["familiar"] >= least)
    guess = F.when(F.col(found)["lang_pred"] != UNDETERMINED, F.col(found)["lang_pred"])
    return kept.withColumn("lang", F.coalesce("lang", guess)).drop(found)
