"""A corpus from raw documents to packed batches, each stage on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termweave.llm import buckets, crf, probminhash, toxicity
from termweave.llm.common import table, written
from termweave.llm.queries import tokenizer_json


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of toxic text does not reject; null and empty texts stay, repeated rows are judged each."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages that were learned, one or several; all with letters if none was.

    Texts in other scripts, and null, empty and other texts without letters, go.  A null ``lang`` becomes the text's language.
    """
    return crf.keep_determined(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies; of rows equal in id and text one stays, null texts are one text."""
    return probminhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's place in a batch of its length bucket, by its number of tokens; a row for each row."""
    return buckets.pack_documents(docs, tokenizer_json())


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

# Fitted classifiers and hashed signatures are not SQL; a test compares ``run`` with all pairs in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs)
    return docs
