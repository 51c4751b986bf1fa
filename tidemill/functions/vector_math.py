"""Vector expressions on ``array<float>`` columns, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _double_sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def euclidean(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(_double_sum(F.zip_with(a, b, square)))


def norm(a: Column) -> Column:
    return F.sqrt(_double_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when one vector has no direction."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def argmax(a: Column) -> Column:
    """0-based place of the largest element, the first of equals."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def epoch_text(seconds: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds as UTC text, whatever the session's time zone."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    zero = F.lit(0)
    return F.date_format(start + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)")), pattern)
