"""Sales totals over a star: ``lines(order, item, amount)``, ``invoices(order, date)``, ``items(item, category)``.

Lines are summed per item (and quarter) before the category is joined, so a best-selling item
costs one row there; the join with invoices splits a hot invoice at run time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.relational import in_years


def _dated(lines: DataFrame, invoices: DataFrame, years: Iterable[int] | None) -> DataFrame:
    if years is not None:
        invoices = invoices.where(in_years("date", years))
    return lines.join(invoices, "order_id").select(
        "item_id", "amount", F.year("date").alias("year"), F.quarter("date").alias("quarter")
    )


def by_category(lines: DataFrame, items: DataFrame) -> DataFrame:
    per_item = lines.groupBy("item_id").agg(F.sum("amount").alias("amount"))
    return per_item.join(items, "item_id").groupBy("category").agg(F.sum("amount").alias("total_sales"))


def by_quarter(lines: DataFrame, invoices: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    return _dated(lines, invoices, years).groupBy("year", "quarter").agg(F.sum("amount").alias("total_sales"))


def by_category_year_quarter(
    lines: DataFrame, invoices: DataFrame, items: DataFrame, years: Iterable[int] | None = None
) -> DataFrame:
    per_item = _dated(lines, invoices, years).groupBy("item_id", "year", "quarter").agg(
        F.sum("amount").alias("amount")
    )
    return per_item.join(items, "item_id").groupBy("category", "year", "quarter").agg(
        F.sum("amount").alias("total_sales")
    )


def by_category_quarter(lines: DataFrame, invoices: DataFrame, items: DataFrame) -> DataFrame:
    """All years pooled."""
    return by_category_year_quarter(lines, invoices, items).groupBy("category", "quarter").agg(
        F.sum("total_sales").alias("total_sales")
    )


def best_quarter(per_quarter: DataFrame) -> DataFrame:
    """Each category's quarter with the highest total; the earliest on a tie."""
    key = F.struct((-F.col("total_sales")).alias("neg"), "year", "quarter")
    best = per_quarter.groupBy("category").agg(F.min(key).alias("b"))
    return best.select("category", "b.year", "b.quarter", (-F.col("b.neg")).alias("total_sales"))
