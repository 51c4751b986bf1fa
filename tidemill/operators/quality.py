"""Checks on results: reconciliation of two totals, references without a target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Both sides' measures by key, with the difference; a side without the key counts as 0.

    Null keys match each other, so a null group is compared too.
    """
    a = left.select(F.col(key).alias("__ka"), *[F.col(m).alias(f"{m}_left") for m in measures])
    b = right.select(F.col(key).alias("__kb"), *[F.col(m).alias(f"{m}_right") for m in measures])
    both = a.join(b, F.col("__ka").eqNullSafe(F.col("__kb")), "full_outer")
    out = [F.coalesce("__ka", "__kb").alias(key)]
    for m in measures:
        lhs, rhs = F.coalesce(f"{m}_left", F.lit(0)), F.coalesce(f"{m}_right", F.lit(0))
        out += [lhs.alias(f"{m}_left"), rhs.alias(f"{m}_right"), (lhs - rhs).alias(f"{m}_diff")]
    return both.select(*out)


def fk_audit(checks: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows per foreign key whose target is missing.

    ``checks`` maps a name to (child, child column, parent, parent column). Child rows are counted
    per key first, so a hot key reaches the anti join as one row.
    """
    def one(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
        used = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("__k")).agg(F.count("*").alias("__n"))
        missing = used.join(parent.select(F.col(pk).alias("__k")), "__k", "left_anti")
        return missing.agg(
            F.lit(name).alias("foreign_key"),
            F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("orphan_rows"),
            F.count("*").alias("orphan_keys"),
        )

    return reduce(DataFrame.unionByName, [one(n, *c) for n, c in checks.items()])
