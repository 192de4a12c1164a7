"""How the given tables become documents, lines, edges and token sets."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termweave.functions import document_tokens, letter_runs, line_tokens
from termweave.operators.rows import computed_once
from termweave.runtime import shared_folder, shuffle_partitions
from termweave.sources import scan

LINES_PER_CHUNK = 1024
# Lines of orders that a task sorts, about; fewer where the shuffle is wider.
TASK_ITEMS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, tokens)``: one document per row of the table."""
    table = scan(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    return table.select("doc_id", document_tokens(F.col("text")).alias("tokens"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line_no, tokens)``: the texts cut at line feeds."""
    table = scan(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    cut = table.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return cut.select("doc_id", "line_no", line_tokens(F.col("line")).alias("tokens"))


def line_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tokens, copies)``: equal lines once.  They are merged before they are tokenized, and tokenized in many tasks."""
    table = scan(spark, f"{sf_dir}/documents.parquet", "text")
    cut = table.select(F.explode(F.split("text", "\n")).alias("line"))
    copies = cut.groupBy("line").agg(F.count("*").alias("copies"))
    return copies.select(computed_once(line_tokens(F.col("line")), "tokens"), "copies")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)``: from each part to the next part of the same order.

    The next part is looked for among neighbouring line numbers first, and only the
    first part of each such chunk is compared across a whole order.  An order with very many
    lines is therefore not one sorting group.  Chunks depend on values alone.  The lines are counted when this is
    called: tasks are dealt by their number, as few bytes of an exchange may be very many of them.
    """
    order = ("l_linenumber", "l_partkey")
    items = scan(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey", *order).withColumn(
        "chunk", F.floor(F.col("l_linenumber") / LINES_PER_CHUNK)
    )
    tasks = math.ceil(items.count() / TASK_ITEMS)
    if tasks > 1:
        items = items.repartition(max(tasks, shuffle_partitions(items)), "l_orderkey", "chunk")
    by = W.partitionBy("l_orderkey", "chunk").orderBy(*order)
    inside = items.select(
        "l_orderkey",
        "chunk",
        F.col("l_partkey").alias("src"),
        F.lead("l_partkey").over(by).alias("dst"),
        F.row_number().over(by).alias("at"),
    )
    # Both parts read one exchange; a chunk sends its two ends at most to the next window.
    along = W.partitionBy("l_orderkey").orderBy("chunk", "at")
    ends = inside.where("at = 1 OR dst IS NULL").select(
        "src", "dst", "chunk", F.lead("src").over(along).alias("after")
    )
    across = ends.where("dst IS NULL AND after IS NOT NULL").select("src", F.col("after").alias("dst"))
    return inside.where("dst IS NOT NULL").select("src", "dst").unionByName(across)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(side, id, tokens)``: documents with even ids on side ``r``, with odd ids on side ``s``."""
    table = scan(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    side = F.when(F.col("doc_id") % 2 == 0, "r").otherwise("s").alias("side")
    return table.select(
        side, F.col("doc_id").alias("id"), computed_once(letter_runs(F.col("text")), "tokens")
    )


def saved_lines(table: DataFrame, *columns: str) -> str:
    """The folder of a new text file set with a line ``value value ...`` per row of the table."""
    path = shared_folder(table.sparkSession)
    fields = (F.translate(F.col(c).cast("string"), "\r\n", "  ") for c in columns)
    table.select(F.concat_ws(" ", *fields).alias("value")).write.text(path)
    return path
