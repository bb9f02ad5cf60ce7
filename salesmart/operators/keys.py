"""Surrogate keys.

Dimensions get dense keys in a stated order, so the same members get the same keys in every
run. The fact, by far the largest table, gets dense keys too, in the order it is written in, and no
row moves for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.staging import COMPACT, stage

# The task that wrote a row.
TASK = "_task"

# monotonically_increasing_id() is the partition number above 33 bits of row position.
_POSITION_BITS = 33


def next_key(existing: DataFrame | None, key: str) -> int:
    """The first free key of a dimension or fact."""
    if existing is None:
        return 1
    highest = existing.agg(F.max(key).alias("highest")).first()["highest"]
    return 1 if highest is None else int(highest) + 1


def number_by_range(
    df: DataFrame, order_by: Sequence[str], key: str, start: int = 1
) -> DataFrame:
    """``start - 1 + row_number() over (order by order_by)``, for any number of rows.

    The rows are range-partitioned on the whole ordering, so a value that a third of the rows
    share in its first column is still cut by the later ones. Each task sorts its range and
    notes every row's position; the result is written once. A table with one row per task
    then says how many rows lie before each range. Equal ordering tuples get different keys
    in an arbitrary order, so include a unique column for repeatable keys.
    """
    position_mask = F.lit((1 << _POSITION_BITS) - 1)
    ranged = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumns(
            {
                "_range": F.spark_partition_id(),
                "_position": F.monotonically_increasing_id().bitwiseAND(position_mask),
            }
        ),
        "ranges",
    )
    before = F.sum("_rows").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = stage(
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(before, F.lit(0)).alias("_before")),
        "range-offsets",
    )
    numbered = ranged.join(offsets, "_range").withColumn(
        key, F.col("_before") + F.col("_position") + F.lit(start)
    )
    return numbered.select(key, *df.columns)


def stage_numbered(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` with the number of the task that writes each row."""
    return stage(df.withColumn(TASK, F.spark_partition_id()), name, partition_by, codec=COMPACT)


def number_written(rows: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Gapless unique keys from ``start`` up for written rows, without moving one of them.

    ``rows`` scans a table of ``stage_numbered``, or one partition of it: a Parquet file knows the
    place of each row, and there is one file per task. Rows are counted per task, which reads only
    that column; a table of two numbers per task turns places into keys. It has a few bytes
    per task, so it is broadcast whatever the number of rows.
    """
    before = F.sum("_rows").over(
        Window.orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = stage(
        rows.groupBy(TASK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(TASK, (F.coalesce(before, F.lit(0)) + F.lit(start)).alias("_first")),
        "key-offsets",
    )
    columns = [c for c in rows.columns if c not in (TASK, key)]
    return (
        rows.withColumn("_place", F.col("_metadata.row_index"))
        .join(offsets, TASK)
        .withColumn(key, F.col("_first") + F.col("_place"))
        .select(key, *columns)
    )


def number_dense(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Gapless unique keys from ``start`` up in no stated order; the rows are written once for it."""
    return number_written(stage_numbered(df, "unnumbered"), key, start)
