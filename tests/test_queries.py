"""Every registered query against its SQL counterpart on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as contract
from termweave.plans import inputs
from termweave.plans.queries import QUERIES

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    found = contract.queries()[name](spark, str(TABLES)).toPandas()
    expected = database.execute(contract.oracle_sql()[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    found, expected = (
        t[columns].sort_values(columns, ignore_index=True) for t in (found, expected)
    )
    assert len(found) == len(expected) > 0
    for column in columns:
        assert (found[column].to_numpy() == expected[column].to_numpy()).all()


def test_entry(spark):
    index = contract.entry(spark)
    assert index.columns == ["term", "doc_id", "tfidf"]


def test_next_part_across_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "LINES_PER_CHUNK", 4)
    items = [(order, line, (7 * line + order) % 23) for order in (1, 2) for line in range(1, 40, 3)]
    items += [(3, 5, 9), (3, 5, 2), (4, 1, 1)]
    table = spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    expected = []
    for order in (1, 2, 3, 4):
        parts = [part for o, line, part in sorted(items) if o == order]
        expected += zip(parts, parts[1:], strict=False)
    assert sorted(rows(inputs.edges(spark, str(tmp_path)))) == sorted(expected)
