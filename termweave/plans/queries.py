"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave import sources
from termweave.operators import candidate_scan, cooccurrence, cycles, similarity, tfidf
from termweave.operators.rows import places, unnest
from termweave.plans import inputs
from termweave.runtime import SMALL, shared_folder, stored

THRESHOLD = 0.8


def tokenize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir)
    return unnest(docs, "tokens", "token", position="pos")


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.term_frequency(inputs.documents(spark, sf_dir))


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.document_frequency(tfidf.term_frequency(inputs.documents(spark, sf_dir)))


def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.corpus_size(inputs.documents(spark, sf_dir))


def tfidf_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = tfidf.tfidf_index(inputs.documents(spark, sf_dir))
    # log10 differs between engines in its last bits.
    return index.withColumn("tfidf", F.round("tfidf", 9))


def line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnest(inputs.lines(spark, sf_dir), "tokens", "token", position="pos")


def cooccurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.pair_counts(inputs.line_bag(spark, sf_dir))


def cooccurrence_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.pair_totals(inputs.lines(spark, sf_dir))


def relative_term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.relative_frequency(inputs.line_bag(spark, sf_dir))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.edges(spark, sf_dir)


def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.vertices(inputs.edges(spark, sf_dir))


def _columns(rows: DataFrame, array: str, k: int) -> DataFrame:
    vertices = (F.get(array, F.lit(at)).alias(f"v{at + 1}") for at in range(k))
    return rows.select(*vertices, "n")


def simple_paths_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(cycles.simple_paths(inputs.edges(spark, sf_dir), 3), "path", 3)


def cycles_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(cycles.simple_cycles(inputs.edges(spark, sf_dir), 3), "cycle", 3)


def _cycle_count(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return cycles.count_cycles(inputs.edges(spark, sf_dir), k).select(F.col("n_cycles").cast("bigint"))


def cycle_count_k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cycle_count(spark, sf_dir, 2)


def cycle_count_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cycle_count(spark, sf_dir, 3)


def cycle_count_k4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cycle_count(spark, sf_dir, 4)


def cycle_count_k5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cycle_count(spark, sf_dir, 5)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.records(spark, sf_dir)


def record_token_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.array_join(F.array_sort("tokens"), " ")
    filled = _records(spark, sf_dir).where(F.size("tokens") > 0)
    return filled.select("side", "id", tokens.alias("tokens"))


def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.token_frequency(_records(spark, sf_dir))


def canonical_token_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stored(_records(spark, sf_dir))
    order = similarity.token_order(records)
    sets = similarity.canonical_order(records, order)
    items = sets.select("side", "id", F.posexplode("tokens").alias("at", "token_id"))
    named = similarity.with_tokens(stored(items), order)
    return named.select("side", "id", (F.col("at") + 1).alias("rank"), "token", "freq")


def prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stored(_records(spark, sf_dir))
    order = similarity.token_order(records)
    prefix = similarity.prefixes(similarity.canonical_order(records, order), THRESHOLD)
    named = similarity.with_tokens(stored(prefix), order)
    return named.select("side", "id", "size", "rank", "token")


def similarity_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stored(_records(spark, sf_dir), **SMALL)
    order = similarity.token_order(records)
    sets = similarity.canonical_order(records, order, bitmap=False)
    return candidate_scan.scanned_candidates(sets, similarity.lowest_similarity(THRESHOLD), order)


def set_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.join_records(_records(spark, sf_dir), THRESHOLD)


def _numbered(lines: DataFrame) -> DataFrame:
    """``(line_no, value)``: ordered output lines with their place in it, from 1."""
    kept = stored(lines.withColumn("_at", F.monotonically_increasing_id()))
    known, place = places(kept, F.col("_at"))
    return known.select((place + 1).alias("line_no"), "value")


def similarity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(sources.similarity_lines(set_similarity_join(spark, sf_dir)))


def postings_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posting_fields(_numbered(sources.postings_lines(tfidf_inverted_index(spark, sf_dir))))


def relative_frequency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = cooccurrence.numbered_relative_frequency(inputs.line_bag(spark, sf_dir))
    return _frequency_fields(sources.relative_frequency_lines(numbered, ordered=True))


def _posting_fields(lines: DataFrame) -> DataFrame:
    # Engines write small numbers in different ways, so the fields are read back from the line.
    fields = F.split("value", "[\t,]")
    return lines.select(
        "line_no",
        fields[0].alias("term"),
        fields[1].cast("bigint").alias("doc_id"),
        fields[2].cast("double").alias("tfidf"),
    )


def _frequency_fields(lines: DataFrame) -> DataFrame:
    fields = F.split("value", " ")
    return lines.select(
        "line_no", fields[0].alias("t1"), fields[1].alias("t2"), fields[2].cast("double").alias("freq")
    )


def saved_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    sources.write_postings(tfidf_inverted_index(spark, sf_dir), path, files=7)
    return _posting_fields(sources.read_saved(spark, path))


def saved_relative_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    numbered = cooccurrence.numbered_relative_frequency(inputs.line_bag(spark, sf_dir))
    sources.write_relative_frequencies(numbered, path, ordered=True)
    return _frequency_fields(sources.read_saved(spark, path))


def saved_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    sources.write_similarities(set_similarity_join(spark, sf_dir), path)
    return sources.read_saved(spark, path)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sources.scan(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    docs = sources.read_documents(spark, inputs.saved_lines(table, "doc_id", "text"))
    return unnest(docs, "tokens", "token", position="pos")


def read_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("l_orderkey", "l_partkey", "l_suppkey")
    table = sources.scan(spark, f"{sf_dir}/lineitem.parquet", *columns)
    return sources.read_edges(spark, inputs.saved_lines(table, *columns))


def read_token_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sources.scan(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    sets = sources.read_token_sets(spark, inputs.saved_lines(table, "doc_id", "text"))
    return unnest(sets, "tokens", "token")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        tokenize_documents,
        term_frequency,
        document_frequency,
        corpus_size,
        tfidf_inverted_index,
        line_tokens,
        cooccurrence_counts,
        cooccurrence_totals,
        relative_term_frequency,
        graph_edges,
        graph_vertices,
        simple_paths_k3,
        cycles_k3,
        cycle_count_k2,
        cycle_count_k3,
        cycle_count_k4,
        cycle_count_k5,
        record_token_sets,
        token_frequency,
        canonical_token_order,
        prefix_tokens,
        similarity_candidates,
        set_similarity_join,
        similarity_report,
        postings_report,
        relative_frequency_report,
        saved_postings,
        saved_relative_frequencies,
        saved_similarities,
        read_documents,
        read_edges,
        read_token_sets,
    )
}
