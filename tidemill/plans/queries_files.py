"""Queries that write a given table in another format or as a table, and read it back, in batch or as a stream.

Their files go to a new folder below the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.relational import underscore_names
from tidemill.plans import shop
from tidemill.plans.queries_relational import GOLD_SQL
from tidemill.plans.registry import Tables, as_double, query
from tidemill.sources import files, tables
from tidemill.sources.shared import run_dir
from tidemill.streaming import medallion, replay, runner

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
ORDERS_SQL = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders"
CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def orders(t: Tables) -> DataFrame:
    return t.orders.select(*ORDER_COLUMNS)


def database(t: Tables, root: str) -> str:
    """A database of its own for each run, in the run's folder."""
    name = "run_" + root.rsplit("-", 1)[1]
    tables.create_database(t.spark, name, root)
    return name


@query("scan_json", ORDERS_SQL)
def _(t: Tables) -> DataFrame:
    path = run_dir(t.spark, "json")
    orders(t).write.json(path)
    return files.scan_json(t.spark, path, orders(t).schema)


@query("scan_json_infer", ORDERS_SQL)
def _(t: Tables) -> DataFrame:
    path = run_dir(t.spark, "json")
    orders(t).write.json(path)
    return files.scan_json(t.spark, path).select(*ORDER_COLUMNS)


@query("ctas_json", "SELECT c_custkey, c_name FROM customer")
def _(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "ctas")
    t.customer.select("c_custkey", "c_name").write.json(f"{root}/landing")
    return tables.ctas(t.spark, f"{database(t, root)}.customers", f"SELECT c_custkey, c_name FROM json.`{root}/landing`")


@query("scan_csv", "SELECT * FROM customer")
def _(t: Tables) -> DataFrame:
    path = run_dir(t.spark, "csv")
    t.customer.write.option("header", True).option("sep", ";").csv(path)
    return files.scan_csv(t.spark, f"{path}/part-*.csv", CUSTOMER_DDL, sep=";")


@query("scan_csv_infer", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t: Tables) -> DataFrame:
    path = run_dir(t.spark, "csv")
    t.customer.write.option("header", True).option("sep", ";").csv(path)
    inferred = files.scan_csv(t.spark, path, sep=";", infer=True)
    return inferred.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("save_table", ORDERS_SQL)
def _(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "save")
    return tables.save_table(orders(t), f"{database(t, root)}.orders")


@query("ctas_view", "SELECT p_partkey AS part_key, p_name AS part_name FROM part")
def _(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "view")
    name = database(t, root)
    spaced = t.part.select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("part name"))
    return tables.ctas_view(underscore_names(spaced), f"view_{name}", f"{name}.parts")


@query("ddl_add_columns", "SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS INTEGER) AS rank FROM supplier")
def _(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "alter")
    table = f"{database(t, root)}.suppliers"
    tables.save_table(t.supplier.select("s_suppkey", "s_name"), table)
    return tables.add_columns(t.spark, table, note="STRING", rank="INT")


@query("replay_batches", "SELECT o_orderkey, o_custkey FROM orders")
def _(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "replay")
    replay.stage(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 3, f"{root}/staged")
    replay.land_next(t.spark, f"{root}/staged", f"{root}/landing", everything=True)
    return t.spark.read.option("recursiveFileLookup", True).parquet(f"{root}/landing")


@query("stream_csv", "SELECT c_custkey AS Customer_ID, c_name AS Customer_Name, c_acctbal AS Balance, true AS stamped FROM customer")
def _(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "roads")
    spaced = t.customer.select(
        F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias("Customer Name"), F.col("c_acctbal").alias("Balance")
    )
    spaced.write.option("header", True).csv(f"{root}/landing")
    schema = T.StructType([
        T.StructField("Customer_ID", T.LongType()),
        T.StructField("Customer_Name", T.StringType()),
        T.StructField("Balance", T.DoubleType()),
    ])
    landed = medallion.land_csv(t.spark, f"{root}/landing", schema, f"{database(t, root)}.customers", root)
    return landed.select(*schema.names, F.col("Extract_Time").isNotNull().alias("stamped"))


def run_order_stream(t: Tables, batches: int = 3) -> medallion.Layers:
    """Replay the order records in ``batches`` files and drain them through all layers."""
    root = run_dir(t.spark, "feed")
    name = database(t, root)
    layers = medallion.Layers(f"{name}.orders", f"{name}.orders_facts", f"{name}.sales_by_author")
    records = shop.raw_orders(t)
    replay.stage(records, "order_id", batches, f"{root}/staged")
    replay.land_next(t.spark, f"{root}/staged", f"{root}/landing", everything=True)
    medallion.run(t.spark, layers, root, f"{root}/landing", records.schema, shop.customers(t), shop.books(t))
    return layers


@query("gold_sales_stream", GOLD_SQL)
def _(t: Tables) -> DataFrame:
    return as_double(t.spark.table(run_order_stream(t).gold), "total_sales_amount")


@query(
    "stream_from_table",
    "SELECT o_orderkey, o_custkey FROM orders",
)
def _(t: Tables) -> DataFrame:
    """A table that a stream fills is the source of the next stream."""
    root = run_dir(t.spark, "chain")
    name = database(t, root)
    source = t.orders.select("o_orderkey", "o_custkey")
    source.write.parquet(f"{root}/landing")
    landed = files.stream_files(t.spark, "parquet", f"{root}/landing", source.schema)
    runner.finish(runner.append_stream(landed, f"{name}.first", root), t.spark, f"{name}.first")
    chained = t.spark.readStream.table(f"{name}.first")
    return runner.finish(runner.append_stream(chained, f"{name}.second", root), t.spark, f"{name}.second")
