"""Named queries with the SQL that must give the same rows.

A query reads the given tables whole. Its SQL runs on any engine with the tables as views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def money(column: str | Column) -> Column:
    """Amounts are summed as decimals."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal totals as doubles, for a result that compares alike in every engine."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
