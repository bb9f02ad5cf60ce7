"""Rows that are not there yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.staging import stage


def not_yet_in(
    new: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    null_safe: bool = False,
    repeated: bool = False,
) -> DataFrame:
    """Rows of ``new`` whose key tuple does not occur in ``existing``.

    ``keys`` names the columns on both sides, or maps those of ``new`` to those of
    ``existing``. With plain equality a tuple holding a NULL matches nothing and so counts as
    new every time; ``null_safe`` lets NULL match NULL.

    The existing tuples are made distinct first: copies of one tuple are combined before the
    shuffle, and the join reuses that shuffle. Set ``repeated`` if tuples of ``new`` may occur
    very often: the existing ones are then written, and the join is one whose skewed partitions
    adaptive execution can split.
    """
    pairs = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    known = existing.select(
        *[F.col(f"`{theirs}`").alias(f"_known_{i}") for i, theirs in enumerate(pairs.values())]
    ).distinct()
    if repeated:
        known = stage(known, "known")
    conditions = []
    for i, ours in enumerate(pairs):
        left, right = F.col(f"`{ours}`"), F.col(f"_known_{i}")
        conditions.append(left.eqNullSafe(right) if null_safe else left == right)
    return new.join(known, conditions, "left_anti")


def not_in(new: DataFrame, column: str, existing: DataFrame, existing_column: str) -> DataFrame:
    """SQL ``column NOT IN (select existing_column ...)`` with its NULL rules.

    An empty list keeps every row; a NULL in the list keeps none; a NULL on the left is kept
    only by an empty list. Written as counts plus an anti join, because Spark's own NOT IN
    broadcasts the list whatever its size.
    """
    entries = (
        existing.agg(
            F.struct(
                F.count(F.lit(1)).alias("all"), F.count(existing_column).alias("known")
            ).alias("entries")
        )
    ).scalar()
    empty: Column = entries["all"] == 0
    usable: Column = entries["all"] == entries["known"]
    kept = new.where(empty | (usable & F.col(column).isNotNull()))
    return not_yet_in(kept, existing, {column: existing_column})
