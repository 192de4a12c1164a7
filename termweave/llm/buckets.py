"""Packing into optimal length buckets.

A text's length is its number of token ids by a given tokenizer, or of words without one.

The histogram of all lengths is global; dynamic programming over it chooses the bucket
boundaries that minimise the padding of the whole corpus.  Inside each bucket, rows form batches
that hold at most ``budget`` tokens when each row is padded to the bucket's boundary.

Rows longer than ``longest`` stay out of the histogram, which so has a bounded number of
bins.  They are kept: each is a batch of its own, without padding, in the last bucket.
Null and empty texts have length 0.  Repeated rows are packed one by one.  An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm.common import gapless_ranks, written
from termweave.llm.dac import token_counts

BUCKETS = 16
BUDGET = 65_536
LONGEST = 65_536


def word_count(text: Column) -> Column:
    """Runs of other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least padding, ascending.

    With ``n`` rows in the first ``j`` bins, a bucket from bin ``i`` to ``j`` costs
    ``length[j] * (n[j + 1] - n[i])`` padded tokens.  For each ``j`` the best ``i`` is the
    lowest of lines with slope ``-n[i]`` at ``length[j]``, and both slopes and lengths are
    monotone, so one sweep over a lower envelope finds all of them.  Whole numbers only.
    """
    m = len(lengths)
    if not m:
        return []
    rows = [0]
    for count in counts:
        rows.append(rows[-1] + count)
    cost = [0] + [None] * m  # of the first j bins, with no bucket
    choices: list[list[int]] = []
    for _ in range(min(buckets, m)):
        envelope: list[tuple[int, int, int]] = []  # slope, intercept, bin
        head, chosen, following = 0, [0] * (m + 1), [None] * (m + 1)
        for j in range(m):
            if cost[j] is not None:
                slope, intercept = -rows[j], cost[j]
                while len(envelope) - head >= 2:
                    (s1, c1, _), (s2, c2, _) = envelope[-2], envelope[-1]
                    if (intercept - c1) * (s1 - s2) > (c2 - c1) * (s1 - slope):
                        break
                    envelope.pop()
                envelope.append((slope, intercept, j))
            if len(envelope) == head:
                continue
            x = lengths[j]
            while len(envelope) - head >= 2:
                (s1, c1, _), (s2, c2, _) = envelope[head], envelope[head + 1]
                if s1 * x + c1 < s2 * x + c2:
                    break
                head += 1
            slope, intercept, start = envelope[head]
            following[j + 1] = slope * x + intercept + x * rows[j + 1]
            chosen[j + 1] = start
        choices.append(chosen)
        cost = following
    ends, j = [], m
    for chosen in reversed(choices):
        if j == 0:
            break
        ends.append(lengths[j - 1])
        j = chosen[j]
    return ends[::-1]


def pack(
    rows: DataFrame,
    length: str = "n_tokens",
    order: tuple[str, ...] = ("doc_id",),
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    longest: int = LONGEST,
    row: str | None = None,
) -> DataFrame:
    """``rows`` with ``bucket``, ``pad_to``, ``batch``, ``slot`` and ``padding``.

    ``batch`` counts from 0 inside the bucket and ``slot`` inside the batch.  ``rows`` should
    be narrow and cheap to read again.  ``row`` names a column that numbers the rows, if there may be many equal ones.
    """
    histogram = (
        rows.groupBy(F.least(F.col(length), F.lit(longest + 1)).alias("length")).count().collect()
    )
    bins = sorted((row["length"], row["count"]) for row in histogram)
    short = [(size, count) for size, count in bins if size <= longest]
    ends = best_boundaries([size for size, _ in short], [count for _, count in short], buckets)
    size = F.col(length)
    bucket, pad_to = F.lit(len(ends)), size
    for at in reversed(range(len(ends))):
        fits = size <= ends[at]
        bucket = F.when(fits, at).otherwise(bucket)
        pad_to = F.when(fits, ends[at]).otherwise(pad_to)
    bucketed = rows.withColumn("bucket", bucket.cast("int")).withColumn(
        "pad_to", pad_to.cast("bigint")
    )
    ranked = gapless_ranks(
        bucketed, "bucket", [*order, length], sum(count for _, count in bins), row=row
    )
    capacity = F.when(F.col("bucket") == len(ends), F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("pad_to"))))
    )
    return (
        ranked.withColumn("batch", F.floor(F.col("rank") / capacity).cast("bigint"))
        .withColumn("slot", F.pmod(F.col("rank"), capacity).cast("int"))
        .withColumn("padding", F.col("pad_to") - size)
        .drop("rank")
    )


def pack_documents(docs: DataFrame, tokenizer_json: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, bucket, pad_to, padding, batch, slot)`` of ``(doc_id, text)``."""
    if tokenizer_json is None:
        lengths = docs.select("doc_id", word_count(F.col("text")).alias("n_tokens"))
    else:
        lengths = token_counts(docs, tokenizer_json)
    numbered = written(lengths.withColumn("_row", F.monotonically_increasing_id()))
    packed = pack(numbered, row="_row")
    return packed.select("doc_id", "n_tokens", "bucket", "pad_to", "padding", "batch", "slot")
