"""One spelling of names and types for query results, so engines can be compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

LONG_KEY = "sales_order_key"


def _plain(name: str, data_type: DataType) -> Column:
    value = F.col(f"`{name}`")
    if name.lower() == LONG_KEY or isinstance(data_type, DateType):
        return value.cast("string")
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    if isinstance(data_type, IntegralType):
        return value.cast("bigint")
    if isinstance(data_type, DecimalType):
        return value.cast("bigint" if data_type.scale == 0 else "double")
    if isinstance(data_type, ArrayType):
        return F.concat_ws(",", value)
    return value


def present(df: DataFrame) -> DataFrame:
    """Lower-case names; whole numbers as bigint, other decimals as double, dates as text."""
    return df.select(*[_plain(f.name, f.dataType).alias(f.name.lower()) for f in df.schema])
