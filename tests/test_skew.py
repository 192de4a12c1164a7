import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from termweave.operators.skew import balanced_join, lookup_join


@pytest.mark.parametrize("heavy_keys", [1, 3, 20, 100_000])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_lookup_join_equals_a_join(spark, heavy_keys, kind):
    pick = random.Random(heavy_keys)
    keys = [0] * 300 + [1] * 100 + [pick.randrange(2, 60) for _ in range(300)]
    facts = spark.createDataFrame(list(enumerate(keys)), "row long, key long")
    # Key 70 has no facts, and some facts have no key in the lookup.
    lookup = facts.where("key <> 5").groupBy("key").count().union(spark.sql("SELECT 70L, 1L"))
    facts, lookup = (t.withColumn("key", t.key.cast(kind)) for t in (facts, lookup))
    found = lookup_join(facts, lookup, key="key", weight="count", heavy_keys=heavy_keys)
    expected = facts.join(lookup, "key").select(*found.columns)
    assert sorted(rows(found)) == sorted(rows(expected))


def test_long_string_keys_are_not_broadcast(spark):
    facts = spark.createDataFrame([("x" * 1000, i) for i in range(50)] + [("y", 1)], "key string, v long")
    lookup = facts.groupBy("key").count()
    found = lookup_join(facts, lookup, key="key", weight="count")
    assert found.count() == 51


def test_long_hot_key_is_split(spark, request):
    # Without these the small join would not be shuffled, or its partitions put together.
    for setting, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false")):
        name = f"spark.sql.{setting}"
        request.addfinalizer(lambda name=name, before=spark.conf.get(name): spark.conf.set(name, before))
        spark.conf.set(name, value)
    key = "x" * 300
    data = [(key, i) for i in range(200)] + [(f"k{i}", i) for i in range(200)]
    left, right = (spark.createDataFrame(data, f"key string, {name} long") for name in "ab")
    found = balanced_join(left, right, ["key"], heavy_keys=50, cell_rows=20)
    assert found.count() == 200 * 200 + 200
    cells = found.where(F.col("key") == key).select(F.spark_partition_id()).distinct().count()
    assert cells > 1


def test_long_hot_key_meets_a_broadcast(spark):
    data = [("x" * 300, i) for i in range(200)] + [(f"k{i}", i) for i in range(200)]
    facts = spark.createDataFrame(data, "key string, v long")
    lookup = facts.groupBy("key").count()
    found = lookup_join(facts, lookup, key="key", weight="count", heavy_keys=50)
    assert sorted(rows(found)) == sorted(rows(facts.join(lookup, "key").select(*found.columns)))


@pytest.mark.parametrize(("heavy_keys", "cell_rows"), [(1, 1), (50, 7), (1000, 1000), (10_000, 3)])
def test_balanced_join_equals_a_join(spark, heavy_keys, cell_rows):
    pick = random.Random(cell_rows)

    def table(name):
        keys = [0] * 120 + [pick.randrange(1, 25) for _ in range(80)] + [99 if name == "a" else 77] * 60
        # Equal rows must survive as often as they occur.
        data = [(key % 2, key, i // 2) for i, key in enumerate(keys)]
        return spark.createDataFrame(data, f"part long, key long, {name} long")

    left, right = table("a"), table("b")
    found = balanced_join(left, right, ["part", "key"], heavy_keys, cell_rows)
    assert found.columns == ["part", "key", "a", "b"]
    assert sorted(rows(found)) == sorted(rows(left.join(right, ["part", "key"])))
