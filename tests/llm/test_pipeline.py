"""The queries of the training-data folder on the smallest tables, and the pipeline."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from termweave.llm import buckets, crf, probminhash, toxicity
from termweave.llm.queries import ORACLES, QUERIES, tokenizer_json

TABLES = Path("/root/testdata/sf0.001")


def test_every_operator_is_registered_once():
    names = contract.queries()
    for n in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        database.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    found = QUERIES[name](spark, str(TABLES))
    expected = database.execute(ORACLES[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    got = found.toPandas()[columns].sort_values(columns, ignore_index=True)
    assert got.equals(expected[columns].sort_values(columns, ignore_index=True).astype(got.dtypes))


def test_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "near_duplicates", "packing",
    ]
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").limit(80)
    odd = spark.createDataFrame(
        [(10_001, None, None, None, None), (10_002, "", None, None, 0), (10_003, "1 2", None, None, 3)],
        documents.schema,
    )
    docs = documents.unionByName(odd).unionByName(documents.limit(5)).persist()
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    rows = {row.doc_id: row for row in docs.collect()}
    clean = {
        r.doc_id for r in toxicity.score_documents(docs, labels).collect() if not r.predicted
    }
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], str(TABLES)).persist())
    for step in steps[1:-1]:
        assert step.columns == docs.columns
    assert {r.doc_id for r in steps[1].collect()} == clean
    speaking = {r.doc_id for r in crf.keep_determined(steps[1]).collect()}
    assert {r.doc_id for r in steps[2].collect()} == speaking == clean - {10_001, 10_002, 10_003}
    classes = {r.doc_id: r.class_id for r in probminhash.near_duplicates(steps[2]).collect()}
    kept = steps[3].collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(classes.values()))
    assert all(row.text == rows[row.doc_id].text for row in kept)
    assert all(row.lang == rows[row.doc_id].lang or rows[row.doc_id].lang is None for row in kept)
    packed = steps[4].collect()
    assert sorted(r.doc_id for r in packed) == sorted(r.doc_id for r in kept)
    assert {tuple(r) for r in packed} == {
        tuple(r) for r in buckets.pack_documents(steps[3], tokenizer_json()).collect()
    }


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(TABLES))
    assert docs.count() == 0
