"""Small helpers that the operators of this package share."""

from __future__ import annotations

import pickle
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.shared import run_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the folder all executors share: computed once, and safe if they are lost."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fan_out(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def below(key: Column, parts: int) -> Column:
    """A hash of ``key`` as a number under ``parts``."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of this package, whose class travels along; :func:`shared` gives it in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(sent: Broadcast):
    return pickle.loads(sent.value)


def remembered(name: str, key, make: Callable):
    """An object that a worker process keeps from task to task: the last one made, if it is ``name``'s and its
    key is still ``key``. What a task brings along is new each time, so the place is a module of the process.

    Only one is kept: workers outlive a step, and its caches would take memory from the next one."""
    place = sys.modules.setdefault("_tidemill_worker", types.ModuleType("_tidemill_worker"))
    kept = place.__dict__.get("kept")
    if kept is None or kept[0] != name or kept[1] != key:
        kept = None
        forget()
        place.__dict__["kept"] = kept = (name, key, make())
    return kept[2]


def forget() -> None:
    """Lets go of what :func:`remembered` keeps in this worker, for steps that keep nothing themselves."""
    place = sys.modules.get("_tidemill_worker")
    if place is not None and place.__dict__.pop("kept", None) is not None:
        pa.default_memory_pool().release_unused()


class Rows:
    """Collects output rows and gives them as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, size: int = 8192):
        self.schema, self.size, self.columns = schema, size, [[] for _ in schema]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= self.size:
            yield self.take()

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
        self.columns = [[] for _ in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)
