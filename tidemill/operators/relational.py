"""Projections, predicates, joins, aggregates, sorts and set operations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def underscore_names(df: DataFrame) -> DataFrame:
    """Column names with ``_`` for each space."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def in_years(column: str, years: Iterable[int], kind: str = "timestamp_ntz") -> Column:
    """``year(column) IN years`` as date ranges, which parquet can skip row groups by.

    ``kind`` is the column's type: ``date``, ``timestamp`` or ``timestamp_ntz``.
    """
    wanted = sorted(set(years))
    if not wanted:
        return F.lit(False)
    runs: list[list[int]] = []
    for year in wanted:
        if runs and runs[-1][1] == year:
            runs[-1][1] = year + 1
        else:
            runs.append([year, year + 1])
    # Literals of the column's own type: a plain date would put a cast around the column.
    ranges = [
        (F.col(column) >= F.expr(f"{kind}'{date(a, 1, 1)}'"))
        & (F.col(column) < F.expr(f"{kind}'{date(b, 1, 1)}'"))
        for a, b in runs
    ]
    return reduce(Column.__or__, ranges)


def align(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of two frames side by side, matched by an explicit key instead of a row index."""
    return left.join(right, on, "inner")


def lookup(df: DataFrame, names: DataFrame, code: str, name: str) -> DataFrame:
    """Add ``name`` for each ``code``; a code without a name keeps its row, with null."""
    return df.join(names.select(code, name), code, "left")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables in one job."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
         for n, df in tables.items()],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, then by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column))


def mode_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value per group; on a tie the smallest.

    Counts first, so a hot group shuffles one row per distinct value. The pick is a ``min`` of structs,
    which Spark combines map-side after sorting the counts.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("value")))
    return counts.groupBy(group).agg(best.alias("__best")).select(
        group, F.col("__best.value").alias(value), (-F.col("__best.neg")).alias("n")
    )


def accuracy_by_class(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Share of correct predictions per class, over the class's own size; no prediction is wrong."""
    hit = F.coalesce(F.col(actual) == F.col(predicted), F.lit(False)).cast("int")
    return df.groupBy(actual).agg(
        F.count("*").alias("n"), F.sum(hit).alias("n_correct"), F.avg(hit).alias("accuracy")
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: Sequence) -> DataFrame:
    """One row per actual class, one column per class of ``classes``, absent pairs 0.

    ``predicted_other`` counts predictions outside ``classes`` and missing ones, so rows add up to
    the size of the class.
    """
    hits = [F.count(F.when(F.col(predicted) == F.lit(c), 1)).alias(f"predicted_{c}") for c in classes]
    known = F.coalesce(F.col(predicted).isin(list(classes)), F.lit(False))
    return df.groupBy(actual).agg(*hits, F.count(F.when(~known, 1)).alias("predicted_other"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows in a total order."""
    return df.orderBy(*order).limit(k)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def first_per_group(df: DataFrame, group: str, *order: str) -> DataFrame:
    """First row of each group by ``order``: a ``min`` of structs, combined map-side after a sort there."""
    rest = [c for c in df.columns if c != group and c not in order]
    row = F.struct(*order, *rest)
    return df.groupBy(group).agg(F.min(row).alias("__first")).select(group, "__first.*")
