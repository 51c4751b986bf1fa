"""Schemas of the feeds: nested orders, books, customers, road counts, model replies."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the feeds.
BOOK_ITEM = T.StructType([
    T.StructField("book_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("subtotal", T.LongType()),
])

ORDERS_RAW = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_timestamp", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("total", T.IntegerType()),
    T.StructField("books", T.ArrayType(BOOK_ITEM)),
])

ORDERS_BRONZE = T.StructType([
    *ORDERS_RAW.fields,
    T.StructField("_rescued_data", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("processed_timestamp", T.TimestampType()),
])

BOOKS_DDL = "book_id STRING, title STRING, author STRING, category STRING, price DOUBLE"

CUSTOMERS_DDL = "customer_id STRING, email STRING, profile STRING, updated STRING"

ROADS = T.StructType([
    T.StructField("Road_ID", T.IntegerType()),
    T.StructField("Road_Category_Id", T.IntegerType()),
    T.StructField("Road_Category", T.StringType()),
    T.StructField("Region_ID", T.IntegerType()),
    T.StructField("Region_Name", T.StringType()),
    T.StructField("Total_Link_Length_Km", T.DoubleType()),
    T.StructField("Total_Link_Length_Miles", T.DoubleType()),
    T.StructField("All_Motor_Vehicles", T.DoubleType()),
])

REPLY = "summary string, code string, explanation string"
REPLY_WITH_PARTS = (
    "summary string, number_of_parts int, "
    "parts array<struct<sub_header:string, code:string, explanation:string>>"
)
SQL_REPLY = "SQL string, Explanation string"
BRANDS_REPLY = "brand_names array<struct<brand_name:string, country_name:string, reason:string>>"
JOKES_REPLY = "jokes array<struct<setup:string, punchline:string>>"
