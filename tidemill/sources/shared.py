"""The folder, visible to every executor, for checkpoints, landing files and published tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a local session that has none gets a folder on this machine; on a cluster a missing
    setting is an error, since other machines could not read what is written here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no earlier run has used."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
