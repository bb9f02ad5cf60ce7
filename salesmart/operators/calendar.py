"""Calendar rows between the first and the last order day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import calendar_attributes, days_between


def date_range(sales: DataFrame, column: str = "ORDER_DT") -> DataFrame:
    """One row: first day, last day and the number of days from one to the other."""
    return sales.agg(
        F.min(column).alias("first_day"), F.max(column).alias("last_day")
    ).withColumn("n_days", days_between(F.col("first_day"), F.col("last_day")))


def day_spine(sales: DataFrame, column: str = "ORDER_DT") -> DataFrame:
    """Every day of the range with its number from 1; no orders, no days.

    The number is a date difference, so no window has to see all days in one task.
    """
    days = F.explode(F.sequence("first_day", "last_day")).alias("order_dt")
    return date_range(sales, column).select("first_day", days).select(
        "order_dt",
        days_between(F.col("first_day"), F.col("order_dt")).cast("bigint").alias("day_counter"),
    )


def calendar(sales: DataFrame, column: str = "ORDER_DT") -> DataFrame:
    """The spine with the attributes of each day."""
    day = F.col("order_dt")
    attributes = [c.alias(name) for name, c in calendar_attributes(day).items()]
    return day_spine(sales, column).select("order_dt", "day_counter", *attributes)
