"""File and JDBC scans, ingest lineage and rescued data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark reads the files once more to infer one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
) -> DataFrame:
    """CSV with a declared schema, an inferred one (``infer``, an extra pass), or all strings.

    ``path`` may be a glob such as ``dir/export_*.csv``.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def query_files(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """``SELECT *`` straight from files, no table needed."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def stream_files(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: T.StructType | str,
    files_per_batch: int | None = None,
    **options: object,
) -> DataFrame:
    """Incremental file source: each file is read once per checkpoint, in arrival order."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def jdbc_options(
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan split in ``partitions`` ranges of a numeric column.

    The bounds only place the cuts: rows outside them fall in the first or last range.
    """
    if partitions < 1 or lower > upper:
        raise ValueError("need partitions >= 1 and lower <= upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        **extra,
    }


def scan_jdbc(spark: SparkSession, **options: object) -> DataFrame:
    """A database table read in parallel; see :func:`jdbc_options` for the arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def with_lineage(df: DataFrame, stamp: str = "processed_timestamp") -> DataFrame:
    """Add the source file and the ingest clock, which is constant within a (micro-)batch."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_name"),
        F.current_timestamp().alias(stamp),
    )


def rescue_json(raw: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Parse JSON text by ``schema``; fields that do not fit go, as JSON, to ``_rescued_data``.

    A field is rescued when the schema does not name it, or names it with a type its value cannot
    take (the typed column is then null). Text that is no JSON object is rescued whole.
    """
    names = [f.name for f in schema.fields]
    parsed = raw.select(
        *[c for c in raw.columns if c != column],
        F.col(column).alias("__raw"),
        F.from_json(F.col(column), "map<string,string>").alias("__loose"),
        # A value of the wrong type nulls its own field only.
        F.from_json(F.col(column), schema).alias("__t"),
    )

    def unfit(key: Column, value: Column) -> Column:
        misfit = ~key.isin(names)
        for n in names:
            misfit = misfit | ((key == n) & value.isNotNull() & F.col(f"__t.{n}").isNull())
        return misfit

    left = F.map_filter("__loose", unfit)
    rescued = F.when(F.col("__loose").isNull(), F.col("__raw")).when(F.size(left) > 0, F.to_json(left))
    return parsed.select(
        *[c for c in raw.columns if c != column], "__t.*", rescued.alias("_rescued_data")
    )
