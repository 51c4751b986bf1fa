"""Metadata filters: conditions on a key are ORed (or ANDed for numbers), keys are ANDed."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The operators a condition may use, read as ``column op value``.
COMPARE = {
    "EQUAL": operator.eq,
    "NOT_EQUAL": operator.ne,
    "LESS": operator.lt,
    "LESS_EQUAL": operator.le,
    "GREATER": operator.gt,
    "GREATER_EQUAL": operator.ge,
}
CONTAINS = ("INCLUDES", "EXCLUDES")


@dataclass(frozen=True)
class Condition:
    operation: str
    value: Any


@dataclass(frozen=True)
class KeyFilter:
    key: str
    conditions: Sequence[Condition]
    combine: str = "or"


def condition_column(column: Column, condition: Condition) -> Column:
    if condition.operation in COMPARE:
        return COMPARE[condition.operation](column, F.lit(condition.value))
    if condition.operation == "INCLUDES":
        return F.array_contains(column, condition.value)
    if condition.operation == "EXCLUDES":
        return ~F.array_contains(column, condition.value)
    raise ValueError(f"unknown operation {condition.operation}")


def metadata_filter(filters: Sequence[KeyFilter], columns: dict[str, Column] | None = None) -> Column:
    """One predicate for a list of key filters; ``columns`` maps keys to columns if names differ."""
    keys = [f.key for f in filters]
    if len(set(keys)) != len(keys):
        raise ValueError("each key may be filtered once")
    predicate = F.lit(True)
    for f in filters:
        if not f.conditions:
            raise ValueError(f"no condition for {f.key}")
        if f.combine not in ("or", "and"):
            raise ValueError("combine must be 'or' or 'and'")
        if f.combine == "and" and any(isinstance(c.value, str) for c in f.conditions):
            raise ValueError("conditions on strings can only be combined by 'or'")
        column = (columns or {}).get(f.key, F.col(f.key))
        join = Column.__or__ if f.combine == "or" else Column.__and__
        predicate = predicate & reduce(join, [condition_column(column, c) for c in f.conditions])
    return predicate


def active(state: str = "state") -> Column:
    """Only chunks in state ACTIVE may be queried."""
    return F.col(state) == "ACTIVE"
