"""Queries on the star tables: scans, joins, sales totals, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import quality, relational as rel, sampling
from tidemill.operators.filters import Condition, KeyFilter, metadata_filter
from tidemill.plans import medallion, sales, shop
from tidemill.plans.registry import Tables, as_double, money, query
from tidemill.sources import tables
from tidemill.sources.files import scan_parquet, with_lineage

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

BOOK_LINES = """
    lines AS (
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS book_id, l_suppkey AS supplier_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal, CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem
    )"""
GOLD_SQL = f"""
    WITH {BOOK_LINES}
    SELECT p_brand AS author, CAST(sum(subtotal) AS DOUBLE) AS total_sales_amount,
           CAST(sum(quantity) AS BIGINT) AS total_sales_quantity
    FROM orders JOIN customer ON o_custkey = c_custkey
         JOIN lines ON order_id = o_orderkey JOIN part ON book_id = p_partkey
    GROUP BY p_brand"""
FIRST_BOOK_CTE = f"""
    {BOOK_LINES},
    firsts AS (
        SELECT o_orderkey, book_id, subtotal, quantity
        FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (
            SELECT *, row_number() OVER (PARTITION BY order_id
                ORDER BY line, book_id, supplier_id, subtotal, quantity) AS rn FROM lines
        ) ON order_id = o_orderkey AND rn = 1
    ),
    first_sales AS (
        SELECT p_brand AS author, coalesce(sum(subtotal), 0) AS amount, coalesce(sum(quantity), 0) AS quantity
        FROM firsts LEFT JOIN part ON book_id = p_partkey GROUP BY p_brand
    )"""


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(t: Tables) -> DataFrame:
    return scan_parquet(t.spark, f"{t.folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query("ingest_lineage", "SELECT event_id, 'events.parquet' AS file_name, true AS stamped FROM events")
def _(t: Tables) -> DataFrame:
    return with_lineage(t.events.select("event_id", "_metadata")).select(
        "event_id",
        F.element_at(F.split("file_name", "/"), -1).alias("file_name"),
        F.col("processed_timestamp").isNotNull().alias("stamped"),
    )


@query(
    "bronze_orders",
    """SELECT o_orderkey AS order_id, epoch(o_orderdate)::BIGINT AS order_timestamp, o_custkey AS customer_id,
              coalesce(n, 0) AS quantity, o_totalprice AS total
       FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    orders = shop.raw_orders(t).groupBy("order_id", "order_timestamp", "customer_id", "total").agg(
        F.sum("quantity").alias("quantity")
    )
    return as_double(orders, "total")


@query(
    "silver_order_facts",
    """SELECT o_orderkey AS order_id, coalesce(n, 0) AS quantity, o_custkey AS customer_id, c_name AS f_name,
              c_mktsegment AS l_name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date
       FROM orders JOIN customer ON o_custkey = c_custkey
       LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    facts = medallion.order_facts(shop.raw_orders(t), shop.customers(t))
    return facts.groupBy("order_id", "customer_id", "f_name", "l_name", "order_date").agg(
        F.sum("quantity").alias("quantity")
    )


@query(
    "explode_books",
    f"""WITH {BOOK_LINES} SELECT order_id, line, book_id, supplier_id, CAST(subtotal AS DOUBLE) AS subtotal, quantity
        FROM lines JOIN orders ON o_orderkey = order_id""",
)
def _(t: Tables) -> DataFrame:
    return as_double(medallion.explode_books(shop.raw_orders(t)), "subtotal")


@query("gold_sales_by_brand", GOLD_SQL)
def gold_sales_by_brand(t: Tables) -> DataFrame:
    facts = medallion.order_facts(shop.raw_orders(t), shop.customers(t))
    return as_double(medallion.sales_by_author(facts, shop.books(t)), "total_sales_amount")


@query(
    "first_book_sales",
    f"""WITH {FIRST_BOOK_CTE} SELECT author, CAST(amount AS DOUBLE) AS total_sales_amount,
        CAST(quantity AS BIGINT) AS total_sales_quantity FROM first_sales""",
)
def first_book_sales(t: Tables) -> DataFrame:
    facts = medallion.order_facts(shop.raw_orders(t), shop.customers(t))
    return as_double(medallion.first_book_sales(facts, shop.books(t)), "total_sales_amount")


@query("gold_report", f"SELECT * FROM ({GOLD_SQL}) ORDER BY total_sales_amount DESC, author")
def _(t: Tables) -> DataFrame:
    return gold_sales_by_brand(t).orderBy(F.desc("total_sales_amount"), "author")


@query(
    "gold_vs_first_book",
    f"""WITH {FIRST_BOOK_CTE}, gold AS ({GOLD_SQL})
        SELECT coalesce(g.author, f.author) AS author,
               coalesce(g.total_sales_amount, 0) AS total_sales_amount_left,
               coalesce(CAST(f.amount AS DOUBLE), 0) AS total_sales_amount_right,
               round(coalesce(g.total_sales_amount, 0) - coalesce(CAST(f.amount AS DOUBLE), 0), 2) AS total_sales_amount_diff
        FROM gold g FULL OUTER JOIN first_sales f ON g.author = f.author""",
)
def _(t: Tables) -> DataFrame:
    both = quality.reconcile(gold_sales_by_brand(t), first_book_sales(t), "author", ["total_sales_amount"])
    return both.withColumn("total_sales_amount_diff", F.round("total_sales_amount_diff", 2))


@query("rename_columns", "SELECT n_nationkey AS \"nation_key\", n_name AS \"nation_name\" FROM nation")
def _(t: Tables) -> DataFrame:
    spaced = t.nation.select(F.col("n_nationkey").alias("nation key"), F.col("n_name").alias("nation name"))
    return rel.underscore_names(spaced)


@query("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def _(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


@query("filter_length", "SELECT doc_id, length(text) AS n FROM documents WHERE length(text) < 10000")
def _(t: Tables) -> DataFrame:
    return t.documents.where(F.length("text") < 10000).select("doc_id", F.length("text").cast("long").alias("n"))


@query(
    "metadata_filter",
    """SELECT doc_id, source, lang, n_chars FROM documents
       WHERE (n_chars >= 5000 OR n_chars < 500) AND (lang = 'en' OR lang = 'fr') AND list_contains([source, lang], 'en')""",
)
def _(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "source", "lang", "n_chars", F.array("source", "lang").alias("tags"))
    wanted = metadata_filter([
        KeyFilter("n_chars", [Condition("GREATER_EQUAL", 5000), Condition("LESS", 500)]),
        KeyFilter("lang", [Condition("EQUAL", "en"), Condition("EQUAL", "fr")]),
        KeyFilter("tags", [Condition("INCLUDES", "en")]),
    ])
    return docs.where(wanted).drop("tags")


@query("align_by_id", "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def _(t: Tables) -> DataFrame:
    return rel.align(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query(
    "lookup_names",
    "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def _(t: Tables) -> DataFrame:
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rel.lookup(t.customer.select("c_custkey", "c_nationkey"), names, "c_nationkey", "n_name")


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in ALL_TABLES),
)
def _(t: Tables) -> DataFrame:
    return rel.table_counts({n: getattr(t, n) for n in ALL_TABLES})


BY_TYPE = """SELECT p_type AS category, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""
DATED = """SELECT p_type AS category, CAST(year(o_orderdate) AS INTEGER) AS year,
                  CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""
SALES = "CAST(sum(amount) AS DOUBLE) AS total_sales"


@query("sales_by_type", BY_TYPE)
def sales_by_type(t: Tables) -> DataFrame:
    return as_double(sales.by_category(shop.sale_lines(t), shop.sale_items(t)), "total_sales")


@query(
    "sales_price_x_quantity",
    """SELECT p_type AS category, sum(p_retailprice::DECIMAL(18,2) * l_quantity::DECIMAL(18,2))::DOUBLE AS total_sales
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    """Unit price times quantity: quantities are summed per item before prices are joined."""
    per_item = t.lineitem.groupBy("l_partkey").agg(F.sum(money("l_quantity")).alias("quantity"))
    sold = per_item.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    total = F.sum(money("p_retailprice") * F.col("quantity")).cast("double")
    return sold.groupBy(F.col("p_type").alias("category")).agg(total.alias("total_sales"))


@query("top5_types", f"SELECT * FROM ({BY_TYPE}) ORDER BY total_sales DESC, category LIMIT 5")
def _(t: Tables) -> DataFrame:
    return rel.top_k(sales_by_type(t), 5, F.desc("total_sales"), F.asc("category"))


@query("sales_by_quarter", f"SELECT year, quarter, {SALES} FROM ({DATED}) GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return as_double(sales.by_quarter(shop.sale_lines(t), shop.invoices(t)), "total_sales")


@query("sales_by_type_quarter", f"SELECT category, quarter, {SALES} FROM ({DATED}) GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return as_double(
        sales.by_category_quarter(shop.sale_lines(t), shop.invoices(t), shop.sale_items(t)), "total_sales"
    )


@query(
    "sales_by_type_year_quarter",
    f"SELECT category, year, quarter, {SALES} FROM ({DATED}) GROUP BY 1, 2, 3 ORDER BY 2, 3, 1",
)
def _(t: Tables) -> DataFrame:
    totals = sales.by_category_year_quarter(shop.sale_lines(t), shop.invoices(t), shop.sale_items(t))
    return as_double(totals.orderBy("year", "quarter", "category"), "total_sales")


@query(
    "sales_year_in",
    f"SELECT category, year, quarter, {SALES} FROM ({DATED}) WHERE year IN (1997, 1998) GROUP BY 1, 2, 3",
)
def _(t: Tables) -> DataFrame:
    totals = sales.by_category_year_quarter(
        shop.sale_lines(t), shop.invoices(t), shop.sale_items(t), years=(1997, 1998)
    )
    return as_double(totals, "total_sales")


@query(
    "best_quarter_per_type",
    f"""SELECT category, year, quarter, total_sales FROM (
            SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_sales DESC, year, quarter) AS rn
            FROM (SELECT category, year, quarter, {SALES} FROM ({DATED}) GROUP BY 1, 2, 3)) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    totals = sales.by_category_year_quarter(shop.sale_lines(t), shop.invoices(t), shop.sale_items(t))
    return as_double(sales.best_quarter(totals), "total_sales")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return rel.value_counts(t.events, "event_type")


@query("distinct_classes", "SELECT DISTINCT label FROM embeddings")
def _(t: Tables) -> DataFrame:
    return t.embeddings.select("label").distinct()


@query(
    "distinct_counts",
    """SELECT lang, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.groupBy("lang").agg(F.countDistinct("source").alias("n_sources"))


@query("group_mean", "SELECT event_type, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean_value"))


@query(
    "mode_per_group",
    """SELECT user_id, event_type, n FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn
           FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    return rel.mode_per_group(t.events, "user_id", "event_type")


@query(
    "first_per_group",
    """SELECT user_id, ts, event_id, event_type FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    return rel.first_per_group(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")


@query(
    "limit_ordered",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def _(t: Tables) -> DataFrame:
    return rel.top_k(t.orders.select("o_orderkey", "o_totalprice"), 100, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'supplier', s_name, s_nationkey, s_acctbal FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return rel.union_all(c, s)


@query(
    "delete_rows",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE NOT coalesce(o_orderstatus = 'F' AND o_orderpriority = '5-LOW', false)""",
)
def _(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return tables.delete_where(orders, (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))


KEYS = {
    "nation.region": ("nation", "n_regionkey", "region", "r_regionkey"),
    "customer.nation": ("customer", "c_nationkey", "nation", "n_nationkey"),
    "supplier.nation": ("supplier", "s_nationkey", "nation", "n_nationkey"),
    "orders.customer": ("orders", "o_custkey", "customer", "c_custkey"),
    "lineitem.orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "lineitem.part": ("lineitem", "l_partkey", "part", "p_partkey"),
    "lineitem.supplier": ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    "labels.documents": ("labels", "doc_id", "documents", "doc_id"),
    "documents.labels": ("documents", "doc_id", "labels", "doc_id"),
}


@query(
    "fk_audit",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS foreign_key, count(*) AS orphan_rows, count(DISTINCT {fk}) AS orphan_keys
            FROM {child} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})"""
        for name, (child, fk, parent, pk) in KEYS.items()
    ),
)
def _(t: Tables) -> DataFrame:
    return quality.fk_audit(
        {n: (getattr(t, c), fk, getattr(t, p), pk) for n, (c, fk, p, pk) in KEYS.items()}
    )


@query(
    "stratified_sample",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (
           PARTITION BY lang ORDER BY md5(concat(doc_id, ':7')), doc_id) AS rn FROM documents) WHERE rn <= 150""",
)
def _(t: Tables) -> DataFrame:
    return sampling.stratified_sample(t.documents.select("doc_id", "lang"), "lang", "doc_id", 150, seed=7)


@query(
    "train_test_split",
    """SELECT vec_id, label, part FROM (SELECT *, row_number() OVER (
           PARTITION BY label, part ORDER BY md5(concat(vec_id, ':0')), vec_id) AS rn
       FROM (SELECT vec_id, label, CASE WHEN substr(md5(concat('0:', vec_id)), 1, 4) < 'cccc'
                    THEN 'train' ELSE 'test' END AS part FROM embeddings))
       WHERE rn <= CASE WHEN part = 'train' THEN 100 ELSE 25 END""",
)
def _(t: Tables) -> DataFrame:
    return sampling.train_test_split(t.embeddings.select("vec_id", "label"), "label", "vec_id", 100, 25)
