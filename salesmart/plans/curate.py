"""SOURCE to CURATED: settled orders in one layout, with US dollars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import (
    AMOUNT,
    COUNTRIES,
    CURATED_COLUMNS,
    CURATED_PARTITION,
    LARGE_AMOUNT,
    RATE,
    USD,
    Country,
)
from salesmart.functions.dates import Months, days_in, in_months, order_period
from salesmart.functions.money import to_usd
from salesmart.operators.dedup import latest_file_per_day
from salesmart.operators.filters import settled, with_market
from salesmart.operators.rates import with_rate
from salesmart.operators.sets import union_all
from salesmart.sources.warehouse import MissingTable, Warehouse
from salesmart.staging import side_by_side


def conform(sales: DataFrame, country: Country) -> DataFrame:
    """The CURATED layout of one source's rows; sales in dollars have the rate 1.

    Amounts get the same type in every country, whatever scale they were loaded with: a union
    of decimals of different scale would drop the cents of one of them.
    """
    rate = F.col("EXCHANGE_RATE") if country.rate_column else F.lit(1).cast(RATE)
    amount = F.col("FINAL_ORDER_AMOUNT").try_cast(AMOUNT)
    tax, price = (F.col(c).try_cast(LARGE_AMOUNT) for c in ("TAX_AMOUNT", "UNIT_PRICE"))
    in_usd = to_usd if country.rate_column else lambda value, _: value.try_cast(USD)
    derived = {
        "LOCAL_CURRENCY": F.lit(country.currency),
        "LOCAL_UNIT_PRICE": price,
        "LOCAL_TOTAL_ORDER_AMT": amount,
        "LOCAL_TAX_AMT": tax,
        "EXCHANGE_RATE": rate,
        "USD_TOTAL_ORDER_AMT": in_usd(amount, rate),
        "USD_TAX_AMT": in_usd(tax, rate),
        "CONTACT_NO": F.col(country.contact_column),
        **order_period(F.col("ORDER_DT")),
    }
    return sales.select(
        *[derived.get(name, F.col(name)).alias(name) for name in CURATED_COLUMNS]
    )


def curate(source: DataFrame, country: Country, rates: DataFrame | None = None) -> DataFrame:
    """All steps for one source: filter, label, keep the latest file, convert, conform.

    The latest file is chosen before the rates are joined. Rates hang on the order date, which
    is also the group, so the choice is the same and fewer rows are joined.
    """
    sales = settled(source)
    if country.latest_file_only:
        sales = latest_file_per_day(sales)
    sales = with_market(sales, country)
    if country.rate_column:
        sales = with_rate(sales, rates, country.rate_column)
    return conform(sales, country)


def sales_table(country: Country) -> str:
    """The name of a source's table, the same in every layer."""
    return f"{country.code.lower()}_sales_order"


def curate_warehouse(warehouse: Warehouse) -> None:
    """Refresh the curated table of every source in full; a source that never came has none."""
    rates = warehouse.read("common", "exchange_rate")

    def refresh(country: Country) -> None:
        source = warehouse.find("source", sales_table(country))
        if source is not None:
            curated = curate(source, country, rates)
            warehouse.replace("curated", sales_table(country), curated, CURATED_PARTITION)

    side_by_side(*[lambda c=c: refresh(c) for c in COUNTRIES])


def curate_months(warehouse: Warehouse, months: Mapping[str, Months]) -> None:
    """Curate the given months of each source again, by its code, and leave the others alone.

    Which file is the latest depends on the rows of one day only, so a month of SOURCE rows is
    all that its curated rows depend on.
    """
    rates = warehouse.read("common", "exchange_rate")

    def refresh(country: Country) -> None:
        rows = warehouse.read("source", sales_table(country)).where(days_in(months[country.code]))
        warehouse.replace_partitions(
            "curated", sales_table(country), curate(rows, country, rates), CURATED_PARTITION
        )

    side_by_side(*[lambda c=c: refresh(c) for c in COUNTRIES if months.get(c.code)])


def all_sales(warehouse: Warehouse, months: Months | None = None) -> DataFrame:
    """The curated rows of all sources, of all months or the given ones.

    A source's rows have load keys of their own and carry its country, so no two are equal and
    the union of distinct rows needs no comparison of rows.
    """
    found = [warehouse.find("curated", sales_table(c)) for c in COUNTRIES]
    present = [df.select(*CURATED_COLUMNS) for df in found if df is not None]
    if not present:
        raise MissingTable(f"no curated table below {warehouse.root}")
    sales = union_all(*present)
    return sales if months is None else sales.where(in_months(months, *CURATED_PARTITION))
