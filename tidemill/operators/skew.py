"""Running totals that stay parallel when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BLOCKS = 256
PREFIX = 32


def _place(rows: DataFrame, key: str, ties: tuple[str, ...]) -> Column:
    """What rows of a group are cut by: the key and the ties, up to the first text, of which a prefix."""
    parts = []
    for name in (key, *ties):
        if isinstance(rows.schema[name].dataType, StringType):
            parts.append(F.substring(name, 1, PREFIX).alias(name))
            break
        parts.append(F.col(name))
    return F.struct(*parts)


def _block(cuts: Column, place: Column, blocks: int) -> Column:
    """How many of the sorted ``cuts`` are not above ``place``, by halving."""
    steps = F.lit([1 << s for s in reversed(range((8 * blocks).bit_length()))])
    step = lambda low, jump: F.when(F.get(cuts, low + jump - 1) <= place, low + jump).otherwise(low)
    return F.when(cuts.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), step))


def cuts_of(places: DataFrame, blocks: int) -> DataFrame:
    """``__whose, __cuts``: about ``blocks`` of all places, picked by their hash, sorted, of the groups they fall in.

    A hash under a part of its range picks the same rows wherever and whenever they are read.
    """
    total = places.select(F.lit(1).alias("__one")).agg(F.greatest(F.count("*"), F.lit(1)).alias("n")).scalar()
    picked = F.shiftrightunsigned(F.xxhash64("__whose", "__place"), 2) < F.lit(float(1 << 62)) * (F.lit(blocks) / total)
    return places.where(picked).groupBy("__whose").agg(F.sort_array(F.collect_set("__place")).alias("__cuts"))


def totals_before(
    rows: DataFrame, group: list[str], key: str, value: str, out: str, ties: tuple[str, ...] = (), blocks: int = BLOCKS
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over rows of the group that come before, by ``key`` and ``ties``.

    Keys and ties may be of any type that sorts, and null ones come first; null groups are groups.
    About ``blocks`` places, picked from all rows by their hash, cut the groups that they fall in. A
    small group is rarely cut; a group with a third of the rows has a third of the cuts, and so blocks of
    some ``rows / blocks`` rows. A window runs in each block, which is the one shuffle of the rows.
    Cuts and the totals of blocks are the only other data, some ``blocks`` rows, and they are
    broadcast. They are functions of the rows alone, so whatever is computed again comes out the same, and
    nothing runs before the result is asked for. Rows of a group that agree in all they are cut by
    share a block.
    """
    # A struct of the group's columns is never null, and null fields are equal.
    whose = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    named = rows.select("*", whose.alias("__whose"), _place(rows, key, ties).alias("__place"))
    cuts = cuts_of(named.select("__whose", "__place"), blocks)
    cut = cuts.select(F.col("__whose").alias("__cut_group"), "__cuts")
    block = _block(F.col("__cuts"), F.col("__place"), blocks).alias("__block")

    # Without a group there is one row of cuts and one of offsets, which are values and not tables to join.
    theirs = F.col("__whose") == F.col("__cut_group")
    valued = named.select("__whose", "__place", F.col(value).alias("__value"))
    if group:
        crossing = valued.join(F.broadcast(cut), theirs)
    else:
        crossing = valued.select("*", cut.select("__cuts").scalar().alias("__cuts")).where(F.col("__cuts").isNotNull())
    sums = crossing.select("__whose", block, "__value").groupBy("__whose", "__block").agg(F.sum("__value").alias("__sum"))
    kind = sums.schema["__sum"].dataType
    add = lambda total, b: (total + F.coalesce(b["__sum"], F.lit(0))).cast(kind)
    # A group's blocks are as many as its cuts and one more: their running sums are an expression on one row.
    held = sums.groupBy("__whose").agg(F.sort_array(F.collect_list(F.struct("__block", "__sum"))).alias("__b"))
    running = F.transform("__b", lambda b, i: F.struct(b["__block"], F.aggregate(F.slice("__b", F.lit(1), i), F.lit(0).cast(kind), add)))
    offsets = held.select("__whose", F.map_from_entries(running).alias("__offsets"))
    if group:
        known = offsets.join(F.broadcast(cut), theirs).select("__cut_group", "__cuts", "__offsets")
        told = named.join(F.broadcast(known), theirs, "left")
    else:
        told = named.select("*", cut.select("__cuts").scalar().alias("__cuts"), offsets.select("__offsets").scalar().alias("__offsets"))
    numbered = told.select(*rows.columns, "__whose", block, "__offsets")
    frame = Window.partitionBy("__whose", "__block").orderBy(F.asc_nulls_first(key), *ties).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(frame), F.lit(0))
    return numbered.select(*rows.columns, (inside + F.coalesce(F.col("__offsets")[F.col("__block")], F.lit(0))).alias(out))


def positions(df: DataFrame, group: list[str], key: str, *ties: str, out: str = "position", blocks: int = BLOCKS) -> DataFrame:
    """0-based position of each row in its group, ordered by ``key`` and then by ``ties``."""
    ones = df.select("*", F.lit(1).cast("long").alias("__one"))
    return totals_before(ones, group, key, "__one", out, ties, blocks).drop("__one")
