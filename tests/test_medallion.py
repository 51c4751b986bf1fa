"""Planted orders through the batch steps."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators.quality import fk_audit, reconcile
from tidemill.plans import medallion, sales


def book(i, q, s):
    return {"book_id": i, "quantity": q, "subtotal": s}


ORDERS = [
    ("o1", 0, "c1", 3, 60, [book("b1", 1, 10), book("b2", 1, 20), book("b3", 1, 30)]),
    ("o2", 86399, "c1", 1, 10, [book("b1", 1, 10)]),
    ("o3", 86400, "c2", 0, 0, []),
    ("o4", 1, "nobody", 1, 10, [book("b1", 1, 10)]),
    ("o5", 2, "c3", 1, 99, [book("lost", 1, 99)]),
    ("o6", 3, "c4", 1, 20, [book("b2", 2, 20)]),
]
CUSTOMERS = [
    ("c1", '{"first_name":"Ann","last_name":"Lee"}'),
    ("c2", '{"first_name":"Bo"}'),
    ("c3", "not json"),
    ("c4", '{"first_name":"Cy","last_name":"Day"}'),
]
BOOKS = [("b1", "t", "ada", "x", 1.0), ("b2", "t", "bob", "x", 1.0), ("b3", "t", "bob", "x", 1.0)]


@pytest.fixture(scope="module")
def feed(spark):
    orders = spark.createDataFrame(ORDERS, schemas.ORDERS_RAW)
    customers = spark.createDataFrame(CUSTOMERS, "customer_id string, profile string")
    return orders, customers, spark.createDataFrame(BOOKS, schemas.BOOKS_DDL)


def test_facts(feed):
    orders, customers, _ = feed
    facts = {r.order_id: r for r in medallion.order_facts(orders, customers).collect()}
    assert set(facts) == {"o1", "o2", "o3", "o5", "o6"}
    assert (facts["o1"].f_name, facts["o1"].l_name) == ("Ann", "Lee")
    assert (facts["o3"].f_name, facts["o3"].l_name) == ("Bo", None)
    assert (facts["o5"].f_name, facts["o5"].l_name) == (None, None)
    assert facts["o2"].order_date == "1970-01-01 23:59:59"


def test_totals(feed):
    orders, customers, books = feed
    facts = medallion.order_facts(orders, customers)
    gold = {r.author: (r.total_sales_amount, r.total_sales_quantity) for r in medallion.sales_by_author(facts, books).collect()}
    assert gold == {"ada": (20, 2), "bob": (70, 4)}
    streamed = {r.author: (r.total_sales_amount, r.total_sales_quantity)
                for r in medallion.stream_sales_by_author(facts, books).collect()}
    assert streamed == gold
    first = {r.author: (r.total_sales_amount, r.total_sales_quantity) for r in medallion.first_book_sales(facts, books).collect()}
    # An unknown book and an order without books both count for no author.
    assert first == {"ada": (20, 2), "bob": (20, 2), None: (99, 1)}


def test_no_books_at_all_is_zero(spark, feed):
    _, _, books = feed
    facts = spark.createDataFrame([("o", [])], schemas.T.StructType([
        schemas.T.StructField("order_id", schemas.T.StringType()),
        schemas.T.StructField("books", schemas.T.ArrayType(schemas.BOOK_ITEM)),
    ]))
    assert [tuple(r) for r in medallion.first_book_sales(facts, books).collect()] == [(None, 0, 0)]


@pytest.mark.parametrize("n", [49, 50, 51, 500])
def test_packets_follow_one_rule(spark, n):
    heads = spark.createDataFrame([(1,), (2,), (3,)], "order_id long")
    items = [(1, i // 2, n - i) for i in range(n)] + [(2, 1, 7)]
    nested = medallion.nest_books(heads, spark.createDataFrame(items, "order_id long, line int, amount long"), packet=50)
    rows = sorted(nested.collect(), key=lambda r: (r.order_id, r.packet))
    own = [r for r in rows if r.order_id == 1]
    assert [(r.packet, len(r.books)) for r in own] == [(p, min(50, n - 50 * p)) for p in range(-(-n // 50))]
    assert [(b.line, b.amount) for r in own for b in r.books] == sorted((line, amount) for o, line, amount in items if o == 1)
    assert [(r.packet, len(r.books)) for r in rows if r.order_id != 1] == [(0, 1), (0, 0)]


def test_reconcile_matches_null_groups(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v long")
    b = spark.createDataFrame([("x", 1), (None, 5), ("y", 3)], "k string, v long")
    got = {r.k: r.v_diff for r in reconcile(a, b, "k", ["v"]).collect()}
    assert got == {"x": 0, None: -3, "y": -3}


def test_fk_audit_counts_rows_and_keys(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,)], "pk long")
    assert [tuple(r) for r in fk_audit({"c": (child, "fk", parent, "pk")}).collect()] == [("c", 2, 1)]


def test_best_quarter_ties_go_to_the_earliest(spark):
    rows = [("rock", 2023, 2, Decimal(5)), ("rock", 2023, 1, Decimal(5)), ("jazz", 2024, 4, Decimal(1))]
    totals = spark.createDataFrame(rows, "category string, year int, quarter int, total_sales decimal(18,2)")
    got = {r.category: (r.year, r.quarter) for r in sales.best_quarter(totals).collect()}
    assert got == {"rock": (2023, 1), "jazz": (2024, 4)}


def test_quarter_boundaries_and_empty_categories(spark):
    lines = spark.createDataFrame([(1, 1, 10), (2, 1, 20), (3, None, 5)], "order_id int, item_id int, amount int")
    invoices = spark.sql("""SELECT * FROM VALUES (1, timestamp_ntz'2023-03-31 23:59:59'), (2, timestamp_ntz'2023-04-01 00:00:00'),
                            (3, timestamp_ntz'2024-01-01 00:00:00') AS t(order_id, date)""")
    items = spark.createDataFrame([(1, "rock"), (2, "unsold"), (4, None)], "item_id int, category string")
    got = sorted(map(tuple, sales.by_category_year_quarter(lines, invoices, items).collect()))
    assert got == [("rock", 2023, 1, 10), ("rock", 2023, 2, 20)]
    only = sales.by_quarter(lines, invoices, years=(2024,)).collect()
    assert [tuple(r) for r in only] == [(2024, 1, 5)]
