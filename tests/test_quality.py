from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators import quality
from salesmart.staging import stage
from tests.samples import curated, values


def test_type_errors(spark):
    raw = spark.createDataFrame(
        [("1", "2020-01-01"), ("x", None), (None, "2020-02-30"), ("12.5", "soon")],
        "n string, `a day` string",
    )
    found = quality.type_errors(raw, {"n": "decimal(38,0)", "a day": "date"})
    assert values(found, "column_name", "n_errors") == [("a day", 2), ("n", 1)]


def test_conversion_errors(spark):
    sales = curated(spark, {}, {"USD_TAX_AMT": Decimal("0.51")},
                    {"EXCHANGE_RATE": None, "USD_TOTAL_ORDER_AMT": None, "USD_TAX_AMT": None})
    assert values(quality.conversion_errors(sales), "Country", "n_rows", "n_wrong") == [
        ("India", 3, 1)
    ]


def test_dollars_that_do_not_fit_or_have_no_ground_are_counted(spark):
    tiny = {"EXCHANGE_RATE": Decimal("0.0000001"), "LOCAL_TOTAL_ORDER_AMT": Decimal("1000000.00")}
    rows = [
        {**tiny, "USD_TOTAL_ORDER_AMT": None, "LOCAL_TAX_AMT": None, "USD_TAX_AMT": None},
        {"EXCHANGE_RATE": Decimal(0)},
        {"EXCHANGE_RATE": Decimal(0), "USD_TOTAL_ORDER_AMT": None, "USD_TAX_AMT": None},
        {"EXCHANGE_RATE": Decimal(3), "USD_TOTAL_ORDER_AMT": Decimal("6.666667"),
         "USD_TAX_AMT": Decimal("0.333333")},
    ]
    found = quality.conversion_errors(curated(spark, *rows))
    assert values(found, "n_rows", "n_wrong") == [(4, 2)]


def test_nulls_ranges_and_counts(spark):
    sales = curated(spark, {"PROMOTION_CODE": None}, {"ORDER_QUANTITY": Decimal(-1)})
    assert values(quality.null_profile(sales, ["PROMOTION_CODE", "ORDER_ID"]),
                  "column_name", "n_nulls") == [("ORDER_ID", 0), ("PROMOTION_CODE", 1)]
    rules = {"positive": F.col("ORDER_QUANTITY") > 0}
    assert values(quality.out_of_range(sales, rules), "rule", "n_broken") == [("positive", 1)]
    assert values(quality.row_counts({"a": sales, "b": sales.limit(0)}),
                  "table_name", "n_rows") == [("a", 2), ("b", 0)]


def test_duplicates_and_orphans(spark):
    dimension = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "pk bigint, v string")
    found = quality.duplicate_members({"d": (dimension, "pk", ["v"])})
    assert values(found, "checked", "n_repeated") == [("identity", 1), ("key", 0)]
    fact = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "fk bigint")
    lost = quality.orphans(fact, {"fk": (dimension, "pk")})
    assert values(lost, "foreign_key", "n_orphans") == [("fk", 4)]


def test_orphans_of_all_keys_in_one_pass(spark):
    dimension = spark.createDataFrame([(1,), (2,)], "pk bigint")
    fact = stage(spark.createDataFrame([(1, 1, 3), (2, None, 3), (1, 7, 1)], "a bigint, b int, c bigint"))
    lost = quality.orphans(fact, {k: (dimension, "pk") for k in "abc"})
    assert values(lost, "foreign_key", "n_orphans") == [("a", 0), ("b", 2), ("c", 2)]
    plan = lost._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_counting_what_is_written_reads_no_column(spark):
    rows = stage(curated(spark, {}, {}))
    counted = quality.row_counts({"sales": rows})
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
    assert values(counted, "table_name", "n_rows") == [("sales", 2)]
