"""Session settings for running the jobs outside a managed cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app_name: str = "salesmart") -> SparkSession:
    """A local session for tests and benchmarks.

    On a cluster the session comes from the deployment; the jobs read its settings and
    change none of them. Adaptive execution, on by default, sizes the shuffles and splits
    skewed join partitions.
    """
    shuffle_partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
