"""The operators of this folder as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import (
    angular_negatives,
    bpe,
    buckets,
    crf,
    dac,
    hash_tree,
    multi_index,
    pivots,
    probminhash,
    relative_lz,
    spectral_whitening,
    templates,
    toxicity,
)
from termweave.llm.common import table

TOKENIZER = "word_bpe_49k.json"
SHARDS = 40


def tokenizer_json(name: str = TOKENIZER) -> str:
    """A public tokenizer's file, as the driver reads it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_directly_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.encode_documents(table(spark, sf_dir, "documents"), tokenizer_json())


def op2_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.detect_documents(table(spark, sf_dir, "documents"))


def op3_pivot_table_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(table(spark, sf_dir, "embeddings"), scale=64.0, every=20, k=20)


def op4_site_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract_pages(table(spark, sf_dir, "pages"))


def op5_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op6_optimal_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json())


def op7_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op8_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_documents(
        table(spark, sf_dir, "documents"), hash_tree.tree(SHARDS), hash_tree.tree(SHARDS + 1)
    )


def op9_probminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_json())


def op11_spectral_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = spectral_whitening.whiten(
        table(spark, sf_dir, "embeddings"), components=8, scale=1024.0, offset=100_000
    )
    return spectral_whitening.per_component(whitened)


def op12_angular_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return angular_negatives.mine(vectors, scale=256.0, every=50, positives=5, negatives=3)


def op13_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = relative_lz.remove_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256)
    return stripped.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_directly_addressable_codes,
        op2_crf_language_id,
        op3_pivot_table_top_k,
        op4_site_template_removal,
        op5_pu_toxicity,
        op6_optimal_length_buckets,
        op7_inverted_multi_index,
        op8_weighted_hash_tree,
        op9_probminhash_near_duplicates,
        op10_backtracking_bpe,
        op11_spectral_whitening,
        op12_angular_hard_negatives,
        op13_relative_lempel_ziv,
    )
}

# SQL for the exact searches and the repeated passages; tests hold the others against brute force.
ORACLES: dict[str, str] = {
    "op3_pivot_table_top_k": """
        WITH cast_rows AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        ), fine AS (
            SELECT row_number() OVER () AS row_no, vec_id, list_transform(v, lambda x: floor(64 * x)) AS v
            FROM cast_rows WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.row_no AS query, q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM fine q JOIN fine c ON q.row_no <> c.row_no WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (
                PARTITION BY query ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_angular_hard_negatives": """
        WITH cast_rows AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v,
                (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        ), fine AS (
            SELECT row_number() OVER () AS row_no, vec_id, label, list_transform(v, lambda x: floor(256 * x)) AS v
            FROM cast_rows WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.row_no AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM fine a JOIN fine c ON a.row_no <> c.row_no WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
                row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
            FROM scored WHERE same
        ), ranked AS (
            SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
                row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
            FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
                AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
            WHERE p.place <= 5
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 3
    """,
    "op13_relative_lempel_ziv": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_no, doc_id,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), placed AS (
            SELECT row_no, doc_id, words, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs
        ), windows AS (
            SELECT row_no, doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS passage
            FROM placed WHERE pos + 12 <= len(words)
        ), firsts AS (
            SELECT passage, min(doc_id) AS first_id FROM windows GROUP BY passage
        ), repeated AS (
            SELECT row_no, pos FROM windows JOIN firsts USING (passage) WHERE first_id < doc_id
        ), judged AS (
            SELECT p.row_no, p.pos, p.word, max(r.pos) OVER (
                PARTITION BY p.row_no ORDER BY p.pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
            FROM placed p LEFT JOIN repeated r ON p.row_no = r.row_no AND p.pos = r.pos
        ), counted AS (
            SELECT row_no, count_if(gone)::BIGINT AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept
            FROM judged GROUP BY row_no
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN counted USING (row_no)
    """,
}
