"""What lies in the landing area, without reading file contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landing_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """One row per file ending in ``suffix``: name, directory below ``root``, path, size, time."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    name = F.element_at(F.split("path", "/"), -1)
    directory = F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)*)[^/]*$", 1)
    return files.select(
        name.alias("file_name"),
        F.rtrim(directory, F.lit("/")).alias("partition_dir"),
        "path",
        "length",
        "modificationTime",
    )


def files_per_directory(files: DataFrame) -> DataFrame:
    """Number and bytes of the files in each partition directory."""
    return files.groupBy("partition_dir").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )
