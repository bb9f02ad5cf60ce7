"""Row filters and constant columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import DELIVERED, PAID, Country


def where_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose ``column`` equals ``value``; NULL never does."""
    return df.where(F.col(column) == F.lit(value))


def settled(df: DataFrame) -> DataFrame:
    """Paid and delivered orders."""
    return where_equal(where_equal(df, "PAYMENT_STATUS", PAID), "SHIPPING_STATUS", DELIVERED)


def with_market(df: DataFrame, country: Country) -> DataFrame:
    """Label the rows of one source with its country and region."""
    return df.withColumns({"Country": F.lit(country.country), "Region": F.lit(country.region)})
