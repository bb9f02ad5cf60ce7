from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.operators import keys


@settings(max_examples=5, deadline=None)
@given(
    rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10**6)), min_size=1, max_size=60,
                  unique_by=lambda r: r[1]),
    partitions=st.integers(1, 7),
    start=st.integers(1, 1000),
)
def test_range_numbers_are_row_numbers(spark, rows, partitions, start):
    df = spark.createDataFrame(rows, "g int, v int").repartition(partitions)
    numbered = keys.number_by_range(df, ["g", "v"], "k", start).collect()
    found = [(r["g"], r["v"]) for r in sorted(numbered, key=lambda r: r["k"])]
    assert found == sorted(rows)
    assert sorted(r["k"] for r in numbered) == list(range(start, start + len(rows)))


def test_range_numbers_with_a_hot_first_column(spark):
    """A third of the rows share the first column; no task gets them all."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("g"), "id"
    )
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in off}
    for name, value in off.items():
        spark.conf.set(name, value)
    try:
        ranged = df.repartitionByRange("g", "id").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in ranged.collect()) < 30_000 / 3
        numbered = keys.number_by_range(df, ["g", "id"], "k")
        checks = numbered.agg(
            F.countDistinct("k").alias("n"), F.min("k").alias("a"), F.max("k").alias("b")
        ).first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert tuple(checks) == (30_000, 1, 30_000)


def test_null_orderings_are_numbered_too(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "g string, v int")
    found = {r["v"]: r["k"] for r in keys.number_by_range(df, ["g", "v"], "k").collect()}
    assert found == {1: 1, 3: 2, 2: 3}


def test_a_few_rows_are_numbered_in_order(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",)], "v string")
    found = {r["v"]: r["k"] for r in keys.number_by_range(df, ["v"], "k", 5).collect()}
    assert found == {"a": 5, "b": 6, "c": 7}


def test_empty_input(spark):
    empty = spark.createDataFrame([], "v string")
    assert keys.number_dense(empty, "k").count() == 0
    assert keys.number_by_range(empty, ["v"], "k").count() == 0


def test_next_key(spark):
    assert keys.next_key(None, "k") == 1
    assert keys.next_key(spark.createDataFrame([], "k bigint"), "k") == 1
    assert keys.next_key(spark.createDataFrame([(4,), (9,)], "k bigint"), "k") == 10


@pytest.mark.parametrize("tasks", [1, 7])
def test_dense_keys_have_no_gap_and_move_no_row(spark, tasks):
    drawn = keys.number_dense(spark.range(0, 1000, 1, tasks).where("id % 3 <> 0"), "k", 100)
    found = drawn.collect()
    assert sorted(r["k"] for r in found) == list(range(100, 100 + len(found)))
    assert sorted(r["id"] for r in found) == [i for i in range(1000) if i % 3]
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_dense_keys_of_one_partition_of_written_rows(spark):
    """Files of rows that have keys already lie beside those of rows that get one."""
    rows = spark.range(0, 500, 1, 5).selectExpr("id", "id % 4 = 0 AS _new")
    staged = keys.stage_numbered(rows, "rows", ["_new"])
    found = keys.number_written(staged.where("_new"), "k", 10).collect()
    assert sorted(r["k"] for r in found) == list(range(10, 10 + 125))
    assert sorted(r["id"] for r in found) == list(range(0, 500, 4))
