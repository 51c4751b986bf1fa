"""Managed and external tables: create, fill, alter, empty, drop, describe."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_database(spark: SparkSession, name: str, path: str) -> None:
    """A layer database whose tables live in the shared folder ``path``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}'")


def create_empty(spark: SparkSession, table: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(table)


def create_table(spark: SparkSession, table: str, ddl: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")


def save_table(df: DataFrame, table: str, mode: str = "errorifexists") -> DataFrame:
    df.write.format("parquet").mode(mode).saveAsTable(table)
    return df.sparkSession.table(table)


def ctas(spark: SparkSession, table: str, select: str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS … AS SELECT``: an existing table is left as it is."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet AS {select}")
    return spark.table(table)


def ctas_view(df: DataFrame, view: str, table: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return ctas(df.sparkSession, table, f"SELECT * FROM {view}")


def add_columns(spark: SparkSession, table: str, **columns: str) -> DataFrame:
    """Add columns; rows written before read as null."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")
    return spark.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def empty_table(spark: SparkSession, table: str) -> None:
    """Delete all rows, keep the table."""
    spark.sql(f"TRUNCATE TABLE {table}")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """What a ``DELETE … WHERE`` leaves: rows for which the condition is false or null."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a database, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").select("tableName")


def describe_tables(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """One row per column of the named tables."""
    parts = [
        spark.sql(f"DESCRIBE TABLE {t}").select(
            F.lit(t).alias("table_name"), "col_name", "data_type"
        )
        for t in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def drop_run_databases(spark: SparkSession, prefix: str = "run_") -> list[str]:
    """Drop the databases that runs of table-writing queries left, with their tables; returns their names.

    A run keeps its database, as its result is read from there; call this when results were read.
    """
    names = [d.name for d in spark.catalog.listDatabases(f"{prefix}*")]
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return names
