"""Small files and folders, on whatever file system the cluster keeps its tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is missing."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(where))


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of the data files in a folder; marks and checksums do not count."""
    files, where = _located(spark, path)
    data = [e for e in files.listStatus(where) if not e.getPath().getName().startswith(("_", "."))]
    return sum(e.getLen() for e in data), len(data)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing if it is missing."""
    files, where = _located(spark, path)
    files.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is missing."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place as a whole: readers see the old text or the new one."""
    jvm = spark.sparkContext._jvm
    files, where = _located(spark, path)
    _, new = _located(spark, f"{path}-{uuid.uuid4().hex}")
    stream = files.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    new, where = files.makeQualified(new), files.makeQualified(where)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), conf).rename(new, where, options)
