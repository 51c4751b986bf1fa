"""The order feed as streams: files to bronze, bronze and customers to silver, silver to gold totals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.plans.medallion import author_totals, order_facts, sales_by_book, stream_sales_by_author
from tidemill.sources.files import stream_files, with_lineage
from tidemill.streaming.runner import append_stream, finish, replace_stream


@dataclass(frozen=True)
class Layers:
    """Table names of the three layers."""

    bronze: str
    silver: str
    gold: str


def bronze(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    return with_lineage(stream_files(spark, "parquet", landing, schema, files_per_batch))


def silver(spark: SparkSession, bronze_table: str, customers: DataFrame) -> DataFrame:
    return order_facts(spark.readStream.table(bronze_table), customers)


def gold(spark: SparkSession, silver_table: str, books: DataFrame) -> DataFrame:
    return stream_sales_by_author(spark.readStream.table(silver_table), books)


def gold_by_book(spark: SparkSession, silver_table: str) -> DataFrame:
    """Running sums per book: the state of the gold stream, a row per book and none per author or order."""
    return sales_by_book(spark.readStream.table(silver_table))


def run(
    spark: SparkSession,
    layers: Layers,
    root: str,
    landing: str,
    schema: T.StructType,
    customers: DataFrame,
    books: DataFrame,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Drain the landing folder through the layers; each layer ends before the next one starts.

    Gold keeps its running sums per book. A micro-batch's totals are joined with the books and summed per
    author when they are published, so however hot a book, the join has one row of it.
    """
    finish(append_stream(bronze(spark, landing, schema, files_per_batch), layers.bronze, root), spark, layers.bronze)
    finish(append_stream(silver(spark, layers.bronze, customers), layers.silver, root), spark, layers.silver)
    totals = replace_stream(gold_by_book(spark, layers.silver), layers.gold, root, lambda sums: author_totals(sums, books))
    return finish(totals, spark, layers.gold)


def land_csv(
    spark: SparkSession, folder: str, schema: T.StructType, table: str, root: str, stamp: str = "Extract_Time"
) -> DataFrame:
    """Drain a folder of CSV files with header into ``table``, with the ingest clock."""
    rows = with_lineage(stream_files(spark, "csv", folder, schema, header=True), stamp).drop("file_name")
    return finish(append_stream(rows, table, root), spark, table)
