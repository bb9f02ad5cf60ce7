from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.config import FACT_COLUMNS, FRANCE, INDIA, RATE, USA
from salesmart.functions.money import to_usd
from salesmart.operators.rates import with_rate
from salesmart.operators.sets import UnlikeDecimals, union_all
from salesmart.plans import kpi
from salesmart.plans.curate import conform
from salesmart.plans.dimensions import load_dimensions
from salesmart.plans.fact import fact_projection, load_fact, sales_fact, star_join, star_of
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import stage
from tests.samples import curated, values

TWO_CONTACTS = ({}, {"CONTACT_NO": "2"}, {"CUSTOMER_NAME": "Bob"})


def test_by_name_fans_out_and_by_grain_does_not(spark):
    sales = stage(curated(spark, *TWO_CONTACTS))
    star = star_of(sales)
    assert values(star_join(sales, star), "ORDER_ID") == [
        ("O-1",), ("O-1",), ("O-2",), ("O-2",), ("O-3",),
    ]
    safe = star_join(sales, star, grain_safe=True)
    assert values(safe, "ORDER_ID") == [("O-1",), ("O-2",), ("O-3",)]
    assert sales_fact(sales, star).columns == list(FACT_COLUMNS)


def test_null_promotion_is_kept_and_null_provider_drops(spark):
    sales = stage(curated(spark, {"PROMOTION_CODE": None}, {"PAYMENT_PROVIDER": None}))
    assert values(star_join(sales, star_of(sales)), "ORDER_ID") == [("O-1",)]


def test_reload_modes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    sales = stage(curated(spark, *TWO_CONTACTS))
    load_dimensions(warehouse, sales)

    def size():
        fact = warehouse.read("consumption", "sales_fact")
        assert fact.select("order_id_pk").distinct().count() == fact.count()
        return fact.count()

    load_fact(warehouse, sales)
    assert size() == 3
    load_fact(warehouse, sales)
    assert size() == 3
    load_fact(warehouse, sales, only_new=False)
    assert size() == 6
    load_fact(warehouse, sales, grain_safe=False, only_new=False)
    assert size() == 11


def test_rates_missing_zero_and_repeated(spark):
    source = spark.createDataFrame(
        [(1, date(2020, 1, d), Decimal("10.00")) for d in (1, 2, 3, 4)],
        "id int, ORDER_DT date, amount decimal(12,2)",
    )
    rates = spark.createDataFrame(
        [(date(2020, 1, 1), Decimal(4)), (date(2020, 1, 2), Decimal(0)),
         (date(2020, 1, 3), Decimal(5)), (date(2020, 1, 3), Decimal(8))],
        "DATE date, USD2INR decimal(10,7)",
    )
    usd = with_rate(source, rates, "USD2INR").select(
        F.dayofmonth("ORDER_DT").alias("d"),
        to_usd(F.col("amount"), F.col("EXCHANGE_RATE")).cast("double").alias("usd"),
    )
    assert values(usd, "d", "usd") == [(1, 2.5), (2, None), (3, 1.25), (3, 2.0), (4, None)]


def test_dollar_sales_have_rate_one(spark):
    row = spark.createDataFrame([(Decimal("3.10"), Decimal("0.30"))],
                                "FINAL_ORDER_AMOUNT decimal(12,2), TAX_AMOUNT decimal(12,2)")
    for c in ("SALES_ORDER_KEY", "ORDER_ID", "CUSTOMER_NAME", "MOBILE_KEY", "Country", "Region",
              "ORDER_QUANTITY", "PROMOTION_CODE", "PAYMENT_STATUS", "SHIPPING_STATUS",
              "PAYMENT_METHOD", "PAYMENT_PROVIDER", "PHONE", "MOBILE", "SHIPPING_ADDRESS"):
        row = row.withColumn(c, F.lit("x"))
    row = row.withColumns({"UNIT_PRICE": F.lit(7), "EXCHANGE_RATE": F.lit(2).cast(RATE),
                           "ORDER_DT": F.lit(date(2020, 5, 1))})
    # a tax loaded in whole units does not take the cents of another country's tax in a union
    whole_tax = row.withColumn("TAX_AMOUNT", F.lit(4).cast("decimal(38,0)"))
    both = union_all(conform(row, INDIA), conform(whole_tax, USA))
    assert values(both, "LOCAL_TAX_AMT", "USD_TAX_AMT") == [
        (Decimal("0.30"), Decimal("0.15")), (Decimal(4), Decimal(4)),
    ]
    out = conform(row, USA).first()
    assert (out["EXCHANGE_RATE"], out["USD_TOTAL_ORDER_AMT"]) == (1, Decimal("3.10"))
    assert (out["LOCAL_CURRENCY"], out["ORDER_QUARTER"], out["CONTACT_NO"]) == ("USD", 2, "x")


def test_country_settings_are_the_only_difference():
    assert [c.directory for c in (INDIA, USA, FRANCE)] == [
        "source=IN/format=csv", "source=US/format=parquet", "source=FR/format=json",
    ]
    assert [f.column for f in INDIA.fields][-2:] == ["MOBILE", "SHIPPING_ADDRESS"]
    assert [f.column for f in FRANCE.fields][-2:] == ["PHONE", "SHIPPING_ADDRESS"]


def test_dashboard_filters(spark):
    sales = stage(curated(
        spark,
        {"ORDER_DT": date(2020, 1, 1), "ORDER_YEAR": 2020},
        {"ORDER_DT": date(2021, 1, 1), "Country": "USA", "Region": "North America"},
        {"ORDER_DT": date(2021, 6, 1)},
    ))
    star = star_of(sales)
    rows = fact_projection(star_join(sales, star, grain_safe=True))

    def chosen(**filters):
        return values(kpi.select_sales(rows, star, kpi.Selection(**filters)), "order_code")

    assert len(chosen()) == 3
    assert chosen(countries=("USA",)) == [("O-2",)]
    assert chosen(year=2021, countries=("India",)) == [("O-3",)]
    assert chosen(first_day=date(2021, 1, 1), last_day=date(2021, 1, 31)) == [("O-2",)]
    assert values(kpi.payment_mix(rows, star), "payment_method", "n_sales", "share") == [
        ("Card", 3, 1.0)
    ]


def test_union_refuses_decimals_that_would_lose_digits(spark):
    cents = spark.createDataFrame([(Decimal("1.25"),)], "tax decimal(12,2)")
    whole = spark.createDataFrame([(Decimal(1),)], "tax decimal(38,0)")
    with pytest.raises(UnlikeDecimals, match="tax"):
        union_all(cents, whole)
    assert union_all(cents, cents).count() == 2
