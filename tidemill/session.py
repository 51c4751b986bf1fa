"""Session settings used by the tests and the benchmark; a cluster passes its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC, ANSI, adaptive session. ``master`` and ``conf`` win over the defaults below."""
    cores = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join side even when that costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": cores,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app).master(master or f"local[{cores}]")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
