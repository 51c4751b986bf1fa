"""Seeded, repeatable samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(key: str, seed: int) -> Column:
    """A pseudo-random order that any engine with md5 can repeat."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


# Samples up to this size are cut inside each task by Spark's limit on ranks; larger ones by a hash threshold.
RANKED = 1000
DIGITS = 3


def _smallest(df: DataFrame, by: list[str], key: str, size: Column, most: int, seed: int) -> DataFrame:
    """The rows of each group whose hashes are its ``size`` smallest, ties by ``key``; ``most`` is the largest size."""
    hashed = df.withColumn("__h", hash_order(key, seed))
    if most <= RANKED:
        # A constant bound of the rank is applied in each input partition before the shuffle.
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("__h", key))
        return hashed.withColumn("__r", rank).where((F.col("__r") <= most) & (F.col("__r") <= size)).drop("__h", "__r")
    # Hashes are counted by their first digits. The group's size is reached within one bin: what is below is in the
    # sample, what is above is not, and only the rows of a bin are ranked, so no group is in one task.
    bins = hashed.select(
        "*", F.struct(*by).alias("__of"), F.conv(F.substring("__h", 1, DIGITS), 16, 10).cast("int").alias("__bin"), size.alias("__size")
    )
    counts = bins.groupBy("__of", "__size", "__bin").agg(F.count("*").alias("__n"))
    held = counts.groupBy("__of", "__size").agg(F.sort_array(F.collect_list(F.struct("__bin", "__n"))).alias("__b"))
    none = F.lit(None).cast("int")
    start = F.struct(F.lit(0).cast("long").alias("below"), none.alias("cut"))

    def reach(state: Column, b: Column) -> Column:
        done = state["cut"].isNotNull()
        reached = state["below"] + b["__n"] >= F.col("__size")
        return F.struct(
            F.when(done | reached, state["below"]).otherwise(state["below"] + b["__n"]).alias("below"),
            F.when(done, state["cut"]).when(reached, b["__bin"]).otherwise(none).alias("cut"),
        )

    cuts = held.select(F.col("__of").alias("__whose"), F.aggregate("__b", start, reach).alias("__c"))
    kept = bins.join(cuts, F.col("__of") == F.col("__whose")).where(F.col("__c.cut").isNull() | (F.col("__bin") <= F.col("__c.cut")))
    rank = F.row_number().over(Window.partitionBy("__of", "__bin").orderBy("__h", key))
    inside = F.col("__c.cut").isNull() | (F.col("__bin") < F.col("__c.cut")) | (F.col("__r") <= F.col("__size") - F.col("__c.below"))
    return kept.withColumn("__r", rank).where(inside).select(*df.columns)


def stratified_sample(df: DataFrame, label: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows per label without replacement, those with the smallest hashes; a label with fewer rows keeps them all.

    For ``n`` up to ``RANKED`` each input partition first drops what cannot be in the sample, so a hot label
    shuffles at most ``n`` rows per partition. For more, hashes are counted per label first, and
    then only rows of the sample move, in 4096 parts a label.
    """
    return _smallest(df, [label], key, F.lit(n), n, seed)


def approximate_sample(df: DataFrame, label: str, fractions: dict, seed: int = 0) -> DataFrame:
    """About a given fraction of each label, in one pass without a shuffle."""
    return df.sampleBy(label, fractions, seed)


def with_part(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 0) -> DataFrame:
    """Add ``part``, ``train`` or ``test``. It depends on the key alone, so it never changes when data is added."""
    cut = format(round(train_share * 0xFFFF), "04x")
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 4)
    return df.withColumn("part", F.when(head < cut, F.lit("train")).otherwise(F.lit("test")))


def train_test_split(
    df: DataFrame, label: str, key: str, n_train: int, n_test: int, train_share: float = 0.8, seed: int = 0
) -> DataFrame:
    """``n_train`` and ``n_test`` rows per label from two disjoint parts; adds ``part``."""
    size = F.when(F.col("part") == "train", F.lit(n_train)).otherwise(F.lit(n_test))
    return _smallest(with_part(df, key, train_share, seed), [label, "part"], key, size, max(n_train, n_test), seed)
