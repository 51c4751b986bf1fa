"""Run a stream into a table: one checkpoint per table, fixed by the run folder.

Appends go through Spark's file sink, whose log makes each micro-batch visible once. Totals are
rewritten by every micro-batch as a new version, and the table is then pointed at it, so a reader
sees one version or the next, and a repeated micro-batch writes its own version again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.sources.shared import run_dir

WRITER = "tidemill.writer"


def _files(spark: SparkSession, folder: str):
    """The file system of a folder, and the folder as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _claim(spark: SparkSession, table: str, root: str) -> str:
    """The table's checkpoint folder; refuses a table that another run folder feeds.

    A second checkpoint would read the source from its beginning and append every row again. A table
    without an owner is ours if the checkpoint is there: then an earlier run of ours made both.
    """
    checkpoint = f"{root}/checkpoints/{table}"
    if spark.catalog.tableExists(table):
        owner = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{WRITER}'").collect()
        fs, path = _files(spark, checkpoint)
        if owner[0]["value"] != checkpoint if owner else not fs.exists(path):
            raise ValueError(f"{table} was not written from {checkpoint}; its rows would be doubled")
        if not owner:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{WRITER}' = '{checkpoint}')")
    return checkpoint


def append_stream(df: DataFrame, table: str, root: str, interval: str | None = None) -> StreamingQuery:
    """Start appending ``df`` to ``table``: all that is there now, or every ``interval`` until stopped.

    The table has its owner from the statement that creates it, before the query starts; so a run that
    broke off anywhere is resumed from its checkpoint.
    """
    spark = df.sparkSession
    checkpoint = _claim(spark, table, root)
    path = f"{root}/tables/{table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({df.schema.toDDL()}) USING parquet LOCATION '{path}' "
        f"TBLPROPERTIES ('{WRITER}' = '{checkpoint}')"
    )
    writer = df.writeStream.queryName(table.replace(".", "_")).format("parquet").outputMode("append")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).option("path", path).toTable(table)


def finish(query: StreamingQuery, spark: SparkSession, table: str) -> DataFrame:
    """Wait for a draining query and return its table, with the files it has now.

    A session remembers a table's files; the query ran in a session of its own.
    """
    query.awaitTermination()
    spark.catalog.refreshTable(table)
    return spark.table(table)


def publish(df: DataFrame, table: str, path: str, spark: SparkSession | None = None, owner: str | None = None) -> None:
    """Write ``df`` to ``path`` and make it the content of ``table``, as seen from ``spark``."""
    df.write.mode("overwrite").parquet(path)
    spark = spark or df.sparkSession
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {table}")
    else:
        owned = f" TBLPROPERTIES ('{WRITER}' = '{owner}')" if owner else ""
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'{owned}")


def retire(spark: SparkSession, versions: str, batch_id: int) -> None:
    """Remove versions older than the one before ``batch_id``: a reader may still be on that one."""
    fs, path = _files(spark, versions)
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.isdigit() and int(name) < batch_id - 1:
            fs.delete(status.getPath(), True)


def replace_stream(
    df: DataFrame, table: str, root: str, shape: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Start keeping ``table`` equal to the full result of an aggregated stream; two versions are kept.

    ``shape`` is applied to each full result before it is published: what a stream, with its one
    aggregation, cannot do.
    """
    spark = df.sparkSession
    checkpoint = _claim(spark, table, root)
    versions = f"{root}/versions/{table}"

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(shape(batch) if shape else batch, table, f"{versions}/{batch_id:010d}", spark, checkpoint)
        retire(spark, versions, batch_id)

    return (
        df.writeStream.queryName(table.replace(".", "_"))
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def reset(spark: SparkSession, tables: list[str], label: str = "run") -> str:
    """Stop the streams, drop the tables, and return a new run folder: nothing is read twice from
    old checkpoints or landing files, and no file is deleted under a running reader."""
    stop_all(spark)
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return run_dir(spark, label)
