"""Bronze, silver and gold as batch functions; the streams run the same ones.

An order record carries its books as ``array<struct<…>>``. An order of any size may arrive: record
``packet`` p of an order has its books at places ``1000 p`` to ``1000 p + 999``, by the same rule for
every order, so packet 0 starts with the first book and no row grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.jsonx import fields
from tidemill.functions.vector_math import epoch_text
from tidemill.operators.skew import positions

PACKET = 1000


def nest_books(orders: DataFrame, items: DataFrame, packet: int = PACKET) -> DataFrame:
    """Order records with their items as the ordered array ``books``; no items, empty array.

    ``orders`` and ``items`` share ``order_id``; items are sorted by their columns, left to right, the
    first of which is a number.
    """
    first, *ties = [c for c in items.columns if c != "order_id"]
    placed = positions(items, ["order_id"], first, *ties)
    nested = (
        placed.select(
            "order_id", F.struct(first, *ties).alias("book"),
            F.floor(F.col("position") / F.lit(packet)).cast("long").alias("packet"),
        )
        .groupBy("order_id", "packet")
        .agg(F.sort_array(F.collect_list("book")).alias("books"))
    )
    return orders.join(nested, "order_id", "left").select(
        *orders.columns,
        F.coalesce("packet", F.lit(0).cast("long")).alias("packet"),
        F.coalesce("books", F.array().cast(nested.schema["books"].dataType)).alias("books"),
    )


def order_facts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known customers with the customer's names from the JSON profile.

    No broadcast hint: Spark broadcasts customers when their files are small enough, and splits a
    hot customer's orders at run time otherwise.
    """
    o, c = orders.alias("o"), customers.alias("c")
    extra = [F.col(f"o.{n}") for n in ("packet",) if n in orders.columns]
    return o.join(c, F.col("o.customer_id") == F.col("c.customer_id"), "inner").select(
        "o.order_id",
        "o.quantity",
        "o.customer_id",
        *extra,
        "o.books",
        *fields(F.col("c.profile"), f_name="first_name", l_name="last_name"),
        epoch_text(F.col("o.order_timestamp")).alias("order_date"),
    )


def explode_books(facts: DataFrame) -> DataFrame:
    """One row per book; orders without books drop out."""
    return facts.select("order_id", F.explode("books").alias("book")).select("order_id", "book.*")


def sales_columns() -> list[Column]:
    return [
        F.sum("subtotal").alias("total_sales_amount"),
        F.sum("quantity").alias("total_sales_quantity"),
    ]


def sales_by_book(facts: DataFrame) -> DataFrame:
    """Amount and quantity per book sold, as a batch or as the one aggregation of a stream."""
    return explode_books(facts).groupBy("book_id").agg(
        F.sum("subtotal").alias("subtotal"), F.sum("quantity").alias("quantity")
    )


def author_totals(per_book: DataFrame, books: DataFrame) -> DataFrame:
    """Sums per book to sums per author; unknown books drop out. A hot book meets the join as one row."""
    return per_book.join(books.select("book_id", "author"), "book_id").groupBy("author").agg(*sales_columns())


def sales_by_author(facts: DataFrame, books: DataFrame) -> DataFrame:
    """Amount and quantity per author over all books sold; unknown books drop out."""
    return author_totals(sales_by_book(facts), books)


def stream_sales_by_author(facts: DataFrame, books: DataFrame) -> DataFrame:
    """The same totals as one streaming aggregation, which may have only one grouping.

    Every book line is joined; :func:`sales_by_book` as the stream and :func:`author_totals` of its
    result join one row per book.
    """
    return (
        explode_books(facts)
        .join(books.select("book_id", "author"), "book_id")
        .groupBy("author")
        .agg(*sales_columns())
    )


def first_book_sales(facts: DataFrame, books: DataFrame) -> DataFrame:
    """Totals by author over each order's first book only; orders without one count as author null."""
    first = F.get("books", F.lit(0))
    orders = facts.where("packet = 0") if "packet" in facts.columns else facts
    per_book = (
        orders.select(
            first["book_id"].alias("book_id"),
            first["subtotal"].alias("subtotal"),
            first["quantity"].alias("quantity"),
        )
        .groupBy("book_id")
        .agg(F.sum("subtotal").alias("subtotal"), F.sum("quantity").alias("quantity"))
    )
    zero = F.lit(0)
    return (
        per_book.join(books.select("book_id", "author"), "book_id", "left")
        .groupBy("author")
        .agg(
            F.coalesce(F.sum("subtotal"), zero).alias("total_sales_amount"),
            F.coalesce(F.sum("quantity"), zero).alias("total_sales_quantity"),
        )
    )
