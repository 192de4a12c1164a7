"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is fitted from confirmed toxic examples and unlabelled text alone.  With
class prior ``p``, positive sample ``P`` and unlabelled sample ``U`` the risk is

    p * mean_P loss(f) + max(0, mean_U loss(-f) - p * mean_P loss(-f))

whose second term, the risk on clean text, cannot truly be negative; where the estimate is, the
step goes the other way, so that the classifier does not overfit to the positives.

A text's features are the set of its words, word beginnings and word ends, hashed.  The sample
for the fit is bounded (``POSITIVES``, ``UNLABELLED`` rows in expectation, picked by a hash of the id);
scores are of whole texts of all rows.  The prior is the share of toxic rows among the labelled ones
that may be learned from, or ``DEFAULT_PRIOR`` where those are of one kind.

Null and empty texts have no feature and get the score of the bias.  An id that is labelled more
than once is toxic if any of its labels says so.  Rows that repeat an id are scored each; for
the fit they are examples each.  Without any confirmed example every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import Memo, fraction, tidy, written

POSITIVES = 4_000
UNLABELLED = 12_000
HELD_OUT = 5
DEFAULT_PRIOR = 0.1
BITS = 20
# A feature counts if so many positives of the sample have it, and a share that exceeds that of
# the unlabelled by so many standard errors.
LEAST_POSITIVES = 3
LEAST_ERRORS = 5.0
KEPT_WORDS = 100_000
NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(HELD_OUT)) == 0


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of one word: itself, its beginnings and its ends."""
    letters = NOT_LETTERS.sub("", word)
    if not letters:
        return ()
    names = {"=" + letters}
    for n in (3, 4, 5):
        if len(letters) > n:
            names |= {"<" + letters[:n], ">" + letters[-n:]}
    return tuple({zlib.crc32(name.encode()) >> (32 - BITS) for name in names})


def text_features(text: str | None, memo: Memo) -> set[int]:
    if not text:
        return set()
    return set().union(*map(memo.__getitem__, set(text.lower().split())))


@dataclass(frozen=True)
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float


def _descend(
    rows: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk with the logistic loss, by Adam over the whole sample."""
    sizes = np.array([len(row) for row in rows])
    flat = np.concatenate(rows) if sizes.sum() else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    w = np.zeros(n_features + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    n_pos, n_unl = positive.sum(), (~positive).sum()
    for step in range(1, steps + 1):
        f = np.bincount(owner, w[flat], len(rows)) + w[-1]
        up = 1 / (1 + np.exp(-np.clip(f, -40, 40)))  # slope of loss(-f); that of loss(f) is up - 1
        clean = np.logaddexp(0, f)
        clean_risk = clean[~positive].sum() / n_unl - prior * clean[positive].sum() / n_pos
        slope = np.where(positive, -prior * up / n_pos, up / n_unl)
        if clean_risk < 0:
            slope = -slope
        else:
            slope = slope + np.where(positive, prior * (up - 1) / n_pos, 0)
        grad = np.append(np.bincount(flat, slope[owner], n_features), slope.sum())
        grad[:-1] += 1e-5 * w[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    f = np.bincount(owner, w[flat], len(rows)) + w[-1]
    return w[:-1], float(w[-1]) - _border(f, positive, prior)


def _border(f: np.ndarray, positive: np.ndarray, prior: float) -> float:
    """The margin that splits best by the same risk with the 0-1 loss, in the middle of such."""
    order = np.argsort(f)
    ordered, is_pos = f[order], positive[order]
    missed = np.cumsum(is_pos) / is_pos.sum()
    above = 1 - np.cumsum(~is_pos) / (~is_pos).sum()
    risk = prior * missed + np.maximum(0, above - prior * (1 - missed))
    best = np.flatnonzero(risk[:-1] <= risk[:-1].min() + 1e-9) if len(f) > 1 else []
    if not len(best):
        return 0.0
    # Of the best places, the one with the widest gap to the next margin.
    at = best[np.argmax(ordered[best + 1] - ordered[best])]
    return float((ordered[at] + ordered[at + 1]) / 2)


def _sampled(docs: DataFrame, ids: DataFrame, positive: bool) -> DataFrame:
    # An id may repeat; more than twice the rows asked for are left out.
    most = 2 * (POSITIVES if positive else UNLABELLED)
    picked = docs.join(F.broadcast(ids.distinct()), "doc_id", "left_semi")
    ordered = picked.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(most)
    return ordered.select("text", F.lit(positive).alias("positive"))


def _constant(bias: float) -> Model:
    return Model(np.zeros(0, dtype=np.int64), np.zeros(0), bias)


def _featured(sample: DataFrame) -> DataFrame:
    """``(positive, features)`` of ``(positive, text)``; features as 32-bit numbers in order."""

    @tidy
    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Memo(word_features, KEPT_WORDS)
        for batch in batches:
            found = [sorted(text_features(text, memo)) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "positive": batch["positive"],
                    "features": [np.array(row, dtype="<u4").tobytes() for row in found],
                }
            )

    return written(sample.mapInPandas(featured, "positive boolean, features binary"))


def _telling_features(featured: DataFrame, n_pos: int, n_unl: int) -> np.ndarray:
    """Features that positives have significantly more often; counted by Spark."""

    @tidy
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for positive, features in zip(batch["positive"], batch["features"], strict=True):
                counts[int(positive), np.frombuffer(features, "<u4")] += 1
        met = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(met), 10_000):
            part = met[at : at + 10_000]
            yield pd.DataFrame({"feature": part, "unl": counts[0, part], "pos": counts[1, part]})

    counts = (
        featured.mapInPandas(counted, "feature long, unl long, pos long")
        .groupBy("feature")
        .agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))
    )
    pooled = (F.col("pos") + F.col("unl")) / (n_pos + n_unl)
    deviation = F.sqrt(
        F.greatest(pooled * (1 - pooled), F.lit(1e-12)) * (1 / n_pos + 1 / n_unl)
    )
    more = F.col("pos") / n_pos - F.col("unl") / n_unl
    kept = counts.where((F.col("pos") >= LEAST_POSITIVES) & (more >= LEAST_ERRORS * deviation))
    # At most 2 ** BITS, and so few only where texts are few.
    return np.sort(np.array([row["feature"] for row in kept.select("feature").collect()], dtype=int))


def fit(sample: DataFrame, prior: float) -> Model:
    """A model from texts ``(positive, text)``, the others being unlabelled."""
    featured = _featured(sample)
    sizes = {row["positive"]: row["count"] for row in featured.groupBy("positive").count().collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_unl:
        return _constant(-40.0 if not n_pos else 0.0)
    kept = _telling_features(featured, n_pos, n_unl)

    def narrowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [np.frombuffer(row, "<u4").astype(np.int64) for row in batch["features"]]
            found = [np.flatnonzero(np.isin(kept, row)).astype("<u4").tobytes() for row in rows]
            yield pd.DataFrame({"positive": batch["positive"], "features": found})

    got = featured.mapInPandas(narrowed, featured.schema).collect()
    got.sort(key=lambda row: (row["positive"], row["features"]))
    rows = [np.frombuffer(row["features"], "<u4").astype(np.int64) for row in got]
    positive = np.array([row["positive"] for row in got], dtype=bool)
    weights, bias = _descend(rows, positive, len(kept), min(max(prior, 0.01), 0.5))
    return Model(kept, weights, bias)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of ``(doc_id, text)`` and ``(doc_id, toxic)``, without held-out rows."""
    labelled = (
        labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n, n_toxic = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return _constant(-40.0)
    prior = n_toxic / n if n_toxic < n else DEFAULT_PRIOR
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    n_docs = texts.select("doc_id").count()
    if not n_docs:
        return _constant(-40.0)
    number = fraction("doc_id")
    toxic_ids = labelled.where((F.col("toxic") == 1) & (number < POSITIVES / n_toxic))
    any_ids = texts.where(number >= 1 - UNLABELLED / n_docs)
    sample = _sampled(texts, toxic_ids.select("doc_id"), True).unionByName(
        _sampled(texts, any_ids.select("doc_id"), False)
    )
    return fit(sample, prior)


def scorer(docs: DataFrame, model: Model):
    """A function of a text column: its toxicity from 0 to 1."""
    # At most 2 ** BITS weights.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @tidy
    def toxicity(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))

        def kept(word: str) -> tuple[int, ...]:
            return tuple(f for f in word_features(word) if f in weight)

        memo = Memo(kept, KEPT_WORDS)
        for batch in texts:
            margins = [
                model.bias + sum(weight[f] for f in sorted(text_features(text, memo)))
                for text in batch
            ]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(margins, dtype=float), -40, 40))))

    return toxicity


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of ``(doc_id, text)``."""
    toxicity = scorer(docs, train(docs, labels))
    scored = docs.select("doc_id", toxicity("text").alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns."""
    return docs.where(scorer(docs, train(docs, labels))("text") < 0.5)
