"""Finding columns by name: any letter case, known other spellings, defaults if absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.config import COLUMN_ALIASES, NO_PROMOTION


class MissingColumn(ValueError):
    """A required column is absent under all of its spellings."""


def find_column(
    df: DataFrame, name: str, aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES
) -> str | None:
    """The column of ``df`` that carries ``name``, or None."""
    by_lower_name = {c.lower(): c for c in df.columns}
    for spelling in (name.lower(), *aliases.get(name.lower(), ())):
        if spelling in by_lower_name:
            return by_lower_name[spelling]
    return None


def resolve_columns(
    df: DataFrame,
    names: Sequence[str],
    aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES,
) -> DataFrame:
    """Project ``names`` out of ``df`` under exactly these names; raise if one is missing."""
    found = {name: find_column(df, name, aliases) for name in names}
    missing = [name for name, column in found.items() if column is None]
    if missing:
        raise MissingColumn(f"no column for {missing} among {df.columns}")
    return df.select(*[F.col(f"`{column}`").alias(name) for name, column in found.items()])


def default_column(df: DataFrame, name: str, default: object) -> DataFrame:
    """Add ``name`` as a constant unless some spelling of it exists."""
    if find_column(df, name) is not None:
        return df
    return df.withColumn(name, F.lit(default))


def or_default(value: Column, default: object = NO_PROMOTION) -> Column:
    """``value``, or the default where it is NULL."""
    return F.coalesce(value, F.lit(default))


def with_promotion(df: DataFrame) -> DataFrame:
    """The promotion code as dimensions and fact know it: absent or NULL becomes 'NA'."""
    df = default_column(df, "promotion_code", NO_PROMOTION)
    actual = find_column(df, "promotion_code")
    replaced = or_default(F.col(f"`{actual}`")).alias("promotion_code")
    return df.select(*[F.col(f"`{c}`") if c != actual else replaced for c in df.columns])
