from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesmart.functions.columns import MissingColumn, find_column, resolve_columns
from salesmart.operators.anti import not_in, not_yet_in
from salesmart.operators.calendar import calendar, date_range, day_spine
from salesmart.operators.sinks import append_or_recreate, append_rows, read_if_present
from salesmart.plans import dimensions as d
from salesmart.plans.dimensions import load_dimensions
from salesmart.sources.warehouse import MissingTable, Warehouse
from tests.samples import curated, values


def test_product_key_parts(spark):
    sales = curated(
        spark, {}, {"MOBILE_KEY": "B/M/Red"}, {"MOBILE_KEY": ""}, {"MOBILE_KEY": None}, {}
    )
    rows = values(d.members(sales, d.PRODUCT), *d.PRODUCT.identity)
    assert rows == [
        (None, None, None, None, None),
        ("", "", None, None, None),
        ("B/M/Red", "B", "M", "Red", None),
        ("Brand/Model/Red/64", "Brand", "Model", "Red", "64"),
    ]


def test_promotion_default(spark):
    sales = curated(spark, {"PROMOTION_CODE": None}, {"PROMOTION_CODE": "P1"})
    assert values(d.members(sales, d.PROMOTION), "promotion_code") == [("NA",), ("P1",)]
    without = sales.drop("PROMOTION_CODE")
    assert values(d.members(without, d.PROMOTION), "promotion_code") == [("NA",)]


def test_other_spellings_and_missing_columns(spark):
    df = spark.createDataFrame([("p", "c")], "Promo_Code string, CONCTACT_NO string")
    assert find_column(df, "promotion_code") == "Promo_Code"
    assert values(resolve_columns(df, ["promotion_code", "contact_no"]),
                  "promotion_code", "contact_no") == [("p", "c")]
    with pytest.raises(MissingColumn, match="region"):
        resolve_columns(df, ["promotion_code", "region"])


def test_second_load_adds_exactly_the_new_member(spark):
    first = d.dimension_rows(curated(spark, {}, {"CONTACT_NO": "2"}), d.CUSTOMER)
    again = curated(spark, {}, {"CONTACT_NO": "2"}, {"CONTACT_NO": "3"})
    second = d.dimension_rows(again, d.CUSTOMER, first)
    assert values(second, "customer_id_pk", "contact_no", "isActive") == [(3, "3", "Y")]
    # the existing table may spell the contact column in the other way
    renamed = first.withColumnRenamed("contact_no", "conctact_no")
    assert values(d.dimension_rows(again, d.CUSTOMER, renamed), "contact_no") == [("3",)]


def test_null_keys_come_again_unless_null_safe(spark):
    sales = curated(spark, {"PAYMENT_PROVIDER": None}, {})
    existing = d.dimension_rows(sales, d.PAYMENT)
    assert d.new_members(sales, d.PAYMENT, existing).count() == 1
    assert d.new_members(sales, d.PAYMENT, existing, null_safe=True).count() == 0


def test_repeated_tuples_on_both_sides(spark):
    new = spark.createDataFrame([("a", 1)] * 50 + [("b", 1)] * 50, "k string, v int")
    known = spark.createDataFrame([("a",)] * 80, "k string")
    for repeated in (False, True):
        assert not_yet_in(new, known, ["k"], repeated=repeated).count() == 50


def test_not_in_follows_sql(spark):
    new = spark.createDataFrame([(1,), (2,), (None,)], "v int")

    def kept(*listed):
        existing = spark.createDataFrame([(x,) for x in listed], "w int")
        ours = values(not_in(new, "v", existing, "w"), "v")
        new.createOrReplaceTempView("not_in_new")
        existing.createOrReplaceTempView("not_in_listed")
        sql = "SELECT v FROM not_in_new WHERE v NOT IN (SELECT w FROM not_in_listed)"
        assert ours == values(spark.sql(sql), "v")
        return ours

    assert kept() == [(None,), (1,), (2,)]
    assert kept(1) == [(2,)]
    assert kept(1, None) == []
    assert kept(None) == []


def test_calendar(spark):
    sales = curated(spark, {"ORDER_DT": date(2020, 2, 28)}, {"ORDER_DT": date(2020, 3, 2)})
    rows = calendar(sales).orderBy("order_dt").collect()
    assert [(r["day_counter"], r["order_dayname"], r["order_dayofweek"], r["order_weekday"])
            for r in rows] == [
        (1, "Fri", 5, "Weekday"), (2, "Sat", 6, "Weekend"), (3, "Sun", 0, "Weekend"),
        (4, "Mon", 1, "Weekday"),
    ]
    assert [r["order_dayofmonth"] for r in rows] == [28, 29, 1, 2]
    assert date_range(sales).first()["n_days"] == 4


def test_empty_calendar_and_single_day(spark):
    assert day_spine(curated(spark, {"ORDER_DT": None})).count() == 0
    assert values(day_spine(curated(spark, {})), "day_counter") == [(1,)]


def test_date_rows_continue_and_restart_the_counter(spark):
    first = d.date_rows(curated(spark, {"ORDER_DT": date(2020, 1, 1)}))
    both = curated(spark, {"ORDER_DT": date(2020, 1, 1)}, {"ORDER_DT": date(2020, 1, 3)})
    more = d.date_rows(both, first)
    assert values(more, "date_id_pk", "day_counter") == [(2, 2), (3, 3)]
    with_null = first.unionByName(first.withColumn("order_dt", F.lit(None).cast("date")))
    assert d.date_rows(both, with_null).count() == 0


def test_warehouse_dimensions_load_twice(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(MissingTable, match="curated.sales"):
        warehouse.require("curated", "sales")
    sales = curated(spark, {}, {"Country": "USA", "Region": "North America"})
    for _ in range(2):
        load_dimensions(warehouse, sales)
        sizes = {x.table: warehouse.read("consumption", x.table).count() for x in d.DIMENSIONS}
        assert sizes == {"region_dim": 2, "product_dim": 1, "promo_code_dim": 2,
                         "customer_dim": 2, "payment_dim": 2}
        assert warehouse.read("consumption", "date_dim").count() == 1
    load_dimensions(warehouse, curated(spark, {"CUSTOMER_NAME": "Bob"}))
    customers = warehouse.read("consumption", "customer_dim")
    assert values(customers, "customer_id_pk") == [(1,), (2,), (3,)]


def test_unusable_target_is_recreated(spark, tmp_path):
    path = str(tmp_path / "promo")
    spark.createDataFrame([("x",)], "other string").write.parquet(path)
    rows = d.dimension_rows(curated(spark, {}), d.PROMOTION)
    assert append_or_recreate(rows, path, d.PROMOTION.identity)
    assert values(read_if_present(spark, path), "promo_code_id_pk", "promotion_code") == [(1, "P1")]
    assert not append_or_recreate(rows, path, d.PROMOTION.identity)
    assert read_if_present(spark, path).count() == 2


def test_only_promotions_are_started_anew(spark, tmp_path):
    """The keys of other dimensions are in the fact; a table that lacks a column is an error."""
    warehouse = Warehouse(spark, str(tmp_path))
    sales = curated(spark, {})
    load_dimensions(warehouse, sales)
    for dimension, column in ((d.PROMOTION, "region"), (d.CUSTOMER, "contact_no")):
        rows = warehouse.read("consumption", dimension.table).drop(column)
        warehouse.replace("consumption", dimension.table, rows)
    with pytest.raises(MissingColumn, match="contact_no"):
        load_dimensions(warehouse, sales)
    assert "region" in warehouse.read("consumption", d.PROMOTION.table).columns
    assert warehouse.read("consumption", d.CUSTOMER.table).count() == 1


def test_append_matches_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    append_rows(spark.createDataFrame([(1, "a")], "n bigint, s string"), path)
    append_rows(spark.createDataFrame([("b", 2)], "s string, n int"), path)
    assert values(read_if_present(spark, path), "n", "s") == [(1, "a"), (2, "b")]
