"""Helpers shared by the operators: reading, batching by bytes, ranking without one task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# White space of the word pattern [^\x20\x09-\x0D]+
WORD_SPACE = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Text that a Python task holds at once, in bytes; one longer document is a batch of its own.
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty without text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WORD_GAP)
    )


def by_bytes(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // limit
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        for begin, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield batch.slice(begin, end - begin)


def give_memory_back() -> None:
    """Return what a task has freed to the system: its worker waits for other tasks beside a JVM that
    may need the room. Without the GNU C library only Arrow's pool is emptied."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def ranked(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """Add ``rank``, gapless from 0 in each ``group``.

    ``rows`` is a written table with a column ``part``. Rows are ordered inside one (part, group)
    and the counts of earlier parts are added, so a group of any size stays spread over its
    parts. Rows that tie on ``order`` must be equal.
    """
    local = Window.partitionBy("part", group).orderBy(*order)
    before = Window.partitionBy(group).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = rows.groupBy("part", group).count()
    starts = counts.select(
        "part", group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rank_before")
    )
    inside = rows.withColumn("rank_inside", F.row_number().over(local) - 1)
    return (
        inside.join(starts, ["part", group])
        .withColumn("rank", (F.col("rank_before") + F.col("rank_inside")).cast("long"))
        .drop("rank_before", "rank_inside")
    )


def literal_table(spark: SparkSession, json_rows: str, schema: str) -> DataFrame:
    """A small table from a JSON text, without an RDD."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json_rows), f"array<struct<{schema}>>")))


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table from the driver's ``rows`` of long columns. It goes to the JVM as Arrow: a table made
    of tuples is an RDD, for which every executor starts Python workers besides those of its other tasks."""
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=names), schema)
