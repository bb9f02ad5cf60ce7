from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.operators.dedup import (
    latest_file_per_day,
    latest_file_per_day_by_key,
    latest_per_key,
)
from tests.samples import files_of, values


def by_rank(df):
    """The definition: rank one within the day, the latest file first."""
    window = Window.partitionBy("ORDER_DT").orderBy(
        F.col("_METADATA_LAST_MODIFIED").desc_nulls_last()
    )
    return df.withColumn("r", F.rank().over(window)).where("r = 1")


def test_ties_and_nulls(spark):
    df = files_of(
        spark,
        (1, "2020-01-01", "2020-02-01"), (2, "2020-01-01", "2020-02-02"),
        (3, "2020-01-01", "2020-02-02"), (4, "2020-01-02", None),
        (5, "2020-01-02", None), (6, None, "2020-02-01"), (7, None, "2020-02-03"),
        (8, "2020-01-03", None), (9, "2020-01-03", "2020-02-01"),
    )
    kept = values(latest_file_per_day(df), "SALES_ORDER_KEY")
    assert kept == [(2,), (3,), (4,), (5,), (7,), (9,)]
    assert kept == values(by_rank(df), "SALES_ORDER_KEY")
    assert kept == values(latest_file_per_day_by_key(df), "SALES_ORDER_KEY")


def test_same_as_rank_with_a_hot_day(spark):
    rng = np.random.default_rng(7)
    rows = []
    for key in range(3000):
        hot = key % 3 == 0
        day = "2020-01-01" if hot else f"2020-02-{rng.integers(1, 29):02d}"
        modified = None if rng.random() < 0.1 else f"2020-03-{rng.integers(1, 6):02d}"
        rows.append((key, day, modified))
    df = files_of(spark, *rows)
    assert values(latest_file_per_day(df), "SALES_ORDER_KEY") == values(
        by_rank(df), "SALES_ORDER_KEY"
    )


def test_latest_per_order(spark):
    df = spark.createDataFrame(
        [("A", 1, "2020-01-01"), ("A", 2, "2020-01-02"), ("A", 3, "2020-01-02"),
         ("B", 4, None), ("B", 5, "2020-01-01"), ("C", 6, None)],
        "ORDER_ID string, SALES_ORDER_KEY int, _METADATA_LAST_MODIFIED string",
    )
    assert values(latest_per_key(df), "SALES_ORDER_KEY") == [(3,), (5,), (6,)]


def test_a_hot_order_is_cut_down_before_the_shuffle(spark):
    plan = latest_per_key(
        spark.range(10).selectExpr(
            "id % 2 as ORDER_ID", "id as SALES_ORDER_KEY", "id as _METADATA_LAST_MODIFIED"
        )
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
