"""Daily exchange rates next to orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import RATE


def rates_for(rates: DataFrame, rate_column: str) -> DataFrame:
    """One currency of the rate table as (EXCHANGE_DATE, EXCHANGE_RATE)."""
    return rates.select(
        F.col("DATE").alias("EXCHANGE_DATE"),
        F.col(rate_column).cast(RATE).alias("EXCHANGE_RATE"),
    )


def with_rate(sales: DataFrame, rates: DataFrame, rate_column: str) -> DataFrame:
    """Left join on the order date: an order without a rate keeps a NULL rate.

    The rate table is a written table of one row per day, so Spark sees its size and
    broadcasts it; the orders are not shuffled.
    """
    daily = rates_for(rates, rate_column)
    return sales.join(daily, F.col("ORDER_DT") == F.col("EXCHANGE_DATE"), "left").drop(
        "EXCHANGE_DATE"
    )
