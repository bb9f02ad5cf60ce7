"""Removing repeated orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.staging import stage


def latest_file_per_day(
    df: DataFrame, day: str = "ORDER_DT", modified: str = "_METADATA_LAST_MODIFIED"
) -> DataFrame:
    """Keep, for each order day, all rows of the file that was modified last.

    This is ``rank() over (partition by day order by modified desc) = 1`` without the window:
    a day may hold a third of all rows, and a window would sort it in one task. The latest
    time of each day comes from a hash aggregate (combined before the shuffle), is written (at
    most one row per calendar day) and joined back. A NULL day is a group of its own, and a
    day with only NULL times keeps them all, as rank does.

    ``df`` is read twice; pass a table scan.
    """
    latest = stage(
        df.groupBy(F.col(day).alias("_day")).agg(F.max(modified).alias("_latest")),
        "latest-file",
    )
    same_day = F.col(day).eqNullSafe(F.col("_day"))
    same_time = F.col(modified).eqNullSafe(F.col("_latest"))
    return df.join(latest, same_day & same_time, "left_semi")


def latest_file_per_day_by_key(
    df: DataFrame,
    key: str = "SALES_ORDER_KEY",
    day: str = "ORDER_DT",
    modified: str = "_METADATA_LAST_MODIFIED",
) -> DataFrame:
    """The same result by joining the kept keys back to the full rows.

    Load keys are unique, so a semi join returns what an inner join returns and can repeat
    nothing. It costs a second join on the key; ``latest_file_per_day`` is the form to use.
    """
    kept = latest_file_per_day(df.select(key, day, modified), day, modified)
    return df.join(kept.select(key), key, "left_semi")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("ORDER_ID",),
    latest_by: Sequence[str] = ("_METADATA_LAST_MODIFIED", "SALES_ORDER_KEY"),
) -> DataFrame:
    """Keep one row per business key, the latest; ``latest_by`` must break every tie.

    Spark turns the row-number filter into a group limit before the shuffle: each map task
    sends at most one row per key, however often the key occurs.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in latest_by]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")
