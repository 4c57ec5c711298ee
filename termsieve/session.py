"""Session settings for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "termsieve", cpus: int | None = None, partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and the benchmark share."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
