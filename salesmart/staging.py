"""Written intermediate tables in the cluster's shared checkpoint folder.

Why written tables: they survive the loss of executors, they cut the lineage, a plan that
must run once (drawn keys, row positions) runs once, and Spark knows their exact size. The
last point is how most broadcasts are decided: Spark compares the file size with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise does a shuffle join, whose skewed partitions
adaptive execution splits. A hint stands only where the size of a table is bounded or was counted.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from salesmart import files

_LOCAL_ROOTS: dict[str, str] = {}
Result = TypeVar("Result")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, which has no other machine to share with, gets a folder of its own
    when the setting is missing.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_ROOTS[app]


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/salesmart/{spark.sparkContext.applicationId}"


#: The folders, one in the other, in which this thread's intermediate tables go.
_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path of its own under the shared folder, in the scope that is open; ``keep`` means the
    one around it."""
    scopes = _SCOPES.get()[:-1] if keep else _SCOPES.get()
    return "/".join([application_folder(spark), *scopes, f"{name}-{uuid.uuid4().hex}"])


@contextmanager
def scratch_scope(spark: SparkSession, name: str = "scope") -> Iterator[str]:
    """Intermediate tables written inside are deleted at the end, but for those that are kept.

    What is computed inside must be written by then, and so must what still reads these tables.
    The shuffles of the plans that are let go are deleted by Spark once the driver has collected
    its garbage, so that is asked for too.
    """
    inner = f"{name}-{uuid.uuid4().hex}"
    token = _SCOPES.set((*_SCOPES.get(), inner))
    try:
        yield inner
    finally:
        folder = "/".join([application_folder(spark), *_SCOPES.get()])
        _SCOPES.reset(token)
        files.delete(spark, folder)
        let_shuffles_go(spark)


_OWN: dict[str, list[str]] = {}


@contextmanager
def own_scratch(spark: SparkSession, *inputs: DataFrame) -> Iterator[None]:
    """Intermediate tables written inside stay until the next such block begins, unless a frame
    that is its input reads them: for steps of which each returns a frame that is written
    before the next one begins."""
    held = _OWN.setdefault(spark.sparkContext.applicationId, [])
    read = [file for df in inputs for file in df.inputFiles()]
    for folder in [f for f in held if not any(f in file for file in read)]:
        files.delete(spark, f"{application_folder(spark)}/{folder}")
        held.remove(folder)
    let_shuffles_go(spark)
    inner = f"own-{uuid.uuid4().hex}"
    held.append(inner)
    token = _SCOPES.set((*_SCOPES.get(), inner))
    try:
        yield
    finally:
        _SCOPES.reset(token)


def let_shuffles_go(spark: SparkSession) -> None:
    """Have the shuffle files of plans that nothing refers to any more deleted."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop(*staged: DataFrame) -> None:
    """Delete intermediate tables that nothing will read any more."""
    for df in staged:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            files.delete(df.sparkSession, folder)


def drop_intermediate(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once its results are written.

    Frames that still read one of them stop working, so this is for the end of a job.
    """
    files.delete(spark, application_folder(spark))


#: The codec of tables that hold whole order lines: some two thirds of the bytes of the default.
COMPACT = "zstd"


def stage(
    df: DataFrame, name: str = "stage", partition_by: Sequence[str] = (), keep: bool = False,
    codec: str | None = None, rows_a_file: int = 0,
) -> DataFrame:
    """Write ``df`` once and return a scan of what was written, one file per task and partition.

    ``keep`` lets the table outlive the scope that is open; ``codec`` is the session's by default.
    ``rows_a_file`` bounds the rows of a file, for rows of many megabytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, keep)
    writer = df.write.option("maxRecordsPerFile", rows_a_file).partitionBy(*partition_by)
    writer.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(*jobs: Callable[[], Result]) -> list[Result]:
    """Run independent jobs at the same time, so that small ones fill the idle executors."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
        return [done.result() for done in running]
