"""The given star tables in the shapes the order and sales operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.medallion import nest_books
from tidemill.plans.registry import Tables, money


def order_items(t: Tables) -> DataFrame:
    """Line number first: it is an order's sequence, the other columns break its ties."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("book_id"),
        F.col("l_suppkey").alias("supplier_id"),
        money("l_extendedprice").alias("subtotal"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )


def order_heads(t: Tables) -> DataFrame:
    midnight = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        (midnight.cast("long") * 86400).alias("order_timestamp"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("total"),
    )


def raw_orders(t: Tables) -> DataFrame:
    """Order records with nested books, as they would land."""
    nested = nest_books(order_heads(t), order_items(t))
    return nested.select(
        "order_id", "order_timestamp", "customer_id", F.size("books").cast("long").alias("quantity"),
        "total", "packet", "books",
    )


def customers(t: Tables) -> DataFrame:
    profile = F.to_json(F.struct(F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name")))
    return t.customer.select(F.col("c_custkey").alias("customer_id"), profile.alias("profile"))


def books(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def sale_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
        money("l_extendedprice").alias("amount"),
    )


def invoices(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("date"))


def sale_items(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_type").alias("category"))
