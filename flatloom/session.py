"""A session with the settings the jobs expect, for benches and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "12g", **settings: str) -> SparkSession:
    """A local session: adaptive execution on, UTC, shuffle partitions at twice the cores.

    On a cluster the caller brings the session; the jobs then only read
    ``spark.checkpoint.dir`` from it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flatloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(2 * cores) if isinstance(cores, int) else "16")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
