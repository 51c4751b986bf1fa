"""Feed a table to a landing folder in numbered steps: ``01.parquet``, ``02.parquet``, …"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage(df: DataFrame, key: str, n: int, staged: str) -> None:
    """Split ``df`` in ``n`` batches by a hash of ``key`` and write them below ``staged``."""
    number = F.format_string("%02d", 1 + F.pmod(F.xxhash64(key), F.lit(n)))
    df.withColumn("batch", number).write.partitionBy("batch").parquet(staged)


def _numbers(spark: SparkSession, folder: str, prefix: str, suffix: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(
        int(n[len(prefix) : len(n) - len(suffix)]) for n in names if n.startswith(prefix) and n.endswith(suffix)
    )


def land_next(spark: SparkSession, staged: str, landing: str, everything: bool = False) -> list[int]:
    """Copy the next batch, or all that are left, to ``landing``; returns the numbers copied.

    Stops after the last staged batch, however many there are.
    """
    done = _numbers(spark, landing, "", ".parquet")
    left = [n for n in _numbers(spark, staged, "batch=", "") if n > max(done, default=0)]
    todo = left if everything else left[:1]
    for n in todo:
        spark.read.parquet(f"{staged}/batch={n:02d}").write.parquet(f"{landing}/{n:02d}.parquet")
    return todo
