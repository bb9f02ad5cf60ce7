"""Putting country tables together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType


class UnlikeDecimals(ValueError):
    """A decimal column has another type in another frame."""


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name.

    Decimals must have the same type everywhere. Spark would widen decimal(12,2) and
    decimal(38,0) to decimal(38,0) and drop the cents, so that is refused.
    """
    types = {f.name.lower(): f.dataType for f in frames[0].schema}
    for field in (f for df in frames[1:] for f in df.schema):
        pair = (types.get(field.name.lower()), field.dataType)
        if pair[0] != pair[1] and all(isinstance(t, DecimalType) for t in pair):
            raise UnlikeDecimals(f"{field.name} is both {pair[0]} and {pair[1]}")
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, each distinct row once."""
    return union_all(*frames).distinct()
