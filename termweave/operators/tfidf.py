"""TF-IDF inverted index over documents ``(doc_id, tokens)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.operators.rows import unnest
from termweave.operators.skew import lookup_join
from termweave.runtime import stored


def term_frequency(docs: DataFrame) -> DataFrame:
    """``(term, doc_id, tf)``: occurrences of each lower-cased term in each document.

    Rows that repeat a document id are merged.
    """
    terms = unnest(docs.select("doc_id", "tokens"), "tokens", "word")
    return terms.groupBy(F.lower("word").alias("term"), "doc_id").agg(F.count("*").alias("tf"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df)``: number of documents that contain the term."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def corpus_size(docs: DataFrame) -> DataFrame:
    """``(n_docs)``: number of documents, those without any word included."""
    return docs.agg(F.count("*").alias("n_docs"))


def tfidf_index(docs: DataFrame) -> DataFrame:
    """``(term, doc_id, tfidf)`` with weight ``tf * log10(N / df)``; zero weights are kept.

    The text is tokenized and its postings are exchanged once; the rest reads those.
    """
    tf = stored(term_frequency(docs))
    postings = lookup_join(tf, stored(document_frequency(tf)), key="term", weight="df")
    idf = F.log10(corpus_size(docs).scalar().cast("double") / F.col("df"))
    return postings.select("term", "doc_id", (F.col("tf") * idf).alias("tfidf"))
