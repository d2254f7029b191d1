"""Local sessions for tests and benchmarks; on a cluster the session comes from the submitter."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "ledgerline", cpus: str | None = None, **conf: str) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.log.level", "ERROR")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
