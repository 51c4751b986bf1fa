"""A Merkle manifest of a dataset: a digest for every row, every group and the whole, and a proof per row.

A row's digest, its leaf, covers its fields. The leaves of a group, in the order of their key, are hashed
in runs of ``fan``, level by level, to the group's subroot; the subroots, in the order of their
groups, are hashed alike to the root. A row's proof is, for every level, the digests before and after its
own in its run: folding a leaf with them gives the root.

The levels are window functions. ``LEVELS`` of them are climbed at once, in blocks of ``fan ** levels``
neighbouring rows, with a shuffle and a sort in all: on each level ``lag`` and ``lead`` at the fixed offsets
of the run's slots give siblings, masked by the slot and the length of the run, and the first row of a run
hashes the parent. What a level's first rows found is then carried down to all rows under them. The blocks'
digests are the rows of the next climb, a thousandth as many. No window holds more than a block,
however large the group is; places in a group come from running totals over range blocks.

Defined cases: a null field is ``-`` in its leaf; a null group is a group and comes first; a null key
comes first and is never tampered; rows that repeat a key are ordered by their leaf, and rows that
agree in everything are a leaf each; a null or empty text is a field like any other; a group with one row has
its leaf as subroot, and one group's subroot is the root; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import table, written
from tidemill.llm.sql import CRC32
from tidemill.operators.skew import positions

FAN = 2
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<before:string,after:string>>"


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**fields: Column) -> Column:
    return digest(*[field(value) for value in fields.values()])


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(steps, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _climbed(rows: DataFrame, fan: int, levels: int) -> DataFrame:
    """``rows`` (``whose, place, n, node``) with ``steps`` of the next levels, and, on the first row of a block,
    the block's digest ``top``."""
    width = fan**levels
    rows = rows.withColumn("block", F.floor(F.col("place") / F.lit(width)).cast("long"))
    order = Window.partitionBy("whose", "block").orderBy("place")
    rows = rows.withColumn("level_0", F.col("node"))
    for level in range(levels):
        span = fan**level
        # A level is climbed while several nodes remain in the group.
        many = F.col("n") > span
        first = F.col("place") % span == 0
        rows = rows.select(
            "*",
            *[F.lag(f"level_{level}", j * span).over(order).alias(f"lag_{j}") for j in range(1, fan)],
            *[F.lead(f"level_{level}", j * span).over(order).alias(f"lead_{j}") for j in range(1, fan)],
        )
        slot = F.floor(F.col("place") / F.lit(span)) % fan
        # The node j slots on exists if its first row does.
        there = lambda j: (slot + j < fan) & (F.col("place") + j * span < F.col("n"))  # noqa: E731,B023
        before = F.concat(F.lit(""), *[F.when(slot >= j, F.col(f"lag_{j}")).otherwise("") for j in reversed(range(1, fan))])
        after = F.concat(F.lit(""), *[F.when(there(j), F.col(f"lead_{j}")).otherwise("") for j in range(1, fan)])
        rows = rows.select(
            *[c for c in rows.columns if not c.startswith(("lag_", "lead_"))],
            F.when(first & many, F.struct(before.alias("before"), after.alias("after"))).alias(f"step_{level}"),
        )
        parent = F.when(many, digest(F.col(f"level_{level}"), F.col(f"step_{level}.after"))).otherwise(F.col(f"level_{level}"))
        rows = rows.withColumn(f"level_{level + 1}", F.when(F.col("place") % (span * fan) == 0, parent)).drop(f"level_{level}")
    carried = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = F.array(*[F.last(f"step_{level}", ignorenulls=True).over(carried) for level in range(levels)])
    kept = [c for c in rows.columns if not c.startswith(("step_", "level_"))]
    rows = rows.select(*kept, steps.alias("steps"), F.col(f"level_{levels}").alias("top"))
    return rows.withColumn("steps", F.filter("steps", lambda s: s.isNotNull()).cast(STEPS))


def climbed(rows: DataFrame, most: int, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``rows`` (``whose, place, n, node`` and others) with the proof ``steps`` up to the group's ``root``.

    ``place`` counts a group's rows from 0, ``n`` is their number, and ``most`` is the largest ``n``.
    """
    width = fan**levels
    here = written(_climbed(rows, fan, levels), "levels")
    tops = here.where(F.col("place") % width == 0).select(
        "whose", F.col("block").alias("place"), F.ceil(F.col("n") / F.lit(width)).cast("long").alias("n"), F.col("top").alias("node")
    )
    if most <= width:
        above = tops.select("whose", F.col("place").alias("block"), F.col("node").alias("root"))
        return here.join(above, ["whose", "block"]).select(*rows.columns, "steps", "root")
    above = climbed(tops, -(-most // width), fan, levels).select(
        "whose", F.col("place").alias("block"), F.col("steps").alias("higher"), "root"
    )
    return here.join(above, ["whose", "block"]).select(*rows.columns, F.concat("steps", "higher").alias("steps"), "root")


def _counted(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``n``, the size of their group ``whose``, and the largest one."""
    counts = written(rows.groupBy("whose").agg(F.count("*").alias("n")), "sizes")
    return rows.join(counts, "whose"), counts.agg(F.max("n")).first()[0] or 0


def manifest(leaves: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (``group, key, leaf`` and others) with their group's ``subroot``, the ``root``, and the
    proof ``steps`` from the leaf to the root."""
    leaves = written(leaves.select("*", F.struct("group").alias("whose"), F.col("leaf").alias("node")), "leaves")
    placed, most = _counted(positions(leaves, ["whose"], "key", "leaf", out="place"))
    inside = climbed(placed, most, fan, levels).withColumnRenamed("root", "subroot").withColumnRenamed("steps", "lower")
    inside = written(inside, "inside")
    subroots = inside.where("place = 0").select(
        F.struct(F.lit(0).alias("all")).alias("whose"), F.col("whose.group").alias("group"), F.col("subroot").alias("node")
    )
    subroots, groups = _counted(written(positions(subroots, [], "group", out="place"), "subroots"))
    above = climbed(subroots, groups, fan, levels).select(F.struct("group").alias("whose"), "steps", "root")
    return inside.join(above, "whose").select(
        *[c for c in leaves.columns if c not in ("whose", "node")], "subroot", "root", F.concat("lower", "steps").alias("steps")
    )


def document_manifest(docs: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``doc_id, group, leaf, tampered, subroot, root, steps`` of every document, grouped by language.

    ``tampered`` is the leaf of the row with one added to ``n_chars``, where 7 divides the CRC-32 of its id.
    """
    fields = {name: F.col(name) for name in FIELDS}
    more = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").alias("key"), leaf_of(**fields).alias("leaf"),
        F.when(changed, leaf_of(**more)).alias("tampered"),
    )
    return manifest(leaves, fan, levels).withColumnRenamed("key", "doc_id")


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    rows = document_manifest(table(spark, folder, "documents"))
    rows = rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("steps")).alias("folded_root"),
    )
    return rows.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


SQL = rf"""
WITH RECURSIVE {CRC32},
d AS (
  SELECT doc_id, lang, n_chars, (crc32 % 7 = 0) AND n_chars IS NOT NULL AS changed,
    {{}} AS leaf_input, {{}} AS other_input
  FROM documents JOIN crc USING (doc_id)),
leaves AS (
  SELECT doc_id, lang, sha256(leaf_input) AS leaf, sha256(CASE WHEN changed THEN other_input ELSE leaf_input END) AS given,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
low AS (
  SELECT lang, 0 AS l, i, n, leaf AS node FROM leaves
  UNION ALL
  SELECT lang, l + 1, i // 2, max((n + 1) // 2), sha256(string_agg(node, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lang, l, i // 2),
subroots AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS l, i, n, subroot AS node FROM subroots
  UNION ALL
  SELECT l + 1, i // 2, max((n + 1) // 2), sha256(string_agg(node, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY l, i // 2),
steps AS (
  SELECT d.doc_id, t.l, s.node, s.i < t.i AS before
  FROM leaves d JOIN low t ON t.lang IS NOT DISTINCT FROM d.lang AND t.i = d.i >> t.l AND t.n > 1
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM t.lang AND s.l = t.l AND s.i = xor(t.i, 1)
  UNION ALL
  SELECT d.doc_id, 1000 + t.l, s.node, s.i < t.i
  FROM leaves d JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang JOIN high t ON t.i = r.i >> t.l AND t.n > 1
  LEFT JOIN high s ON s.l = t.l AND s.i = xor(t.i, 1)),
proofs AS (
  SELECT doc_id, string_agg(coalesce(node, ''), '' ORDER BY l) AS proof,
    list(CASE WHEN before THEN node ELSE '' END || ':' || CASE WHEN before THEN '' ELSE coalesce(node, '') END ORDER BY l) AS steps
  FROM steps GROUP BY doc_id),
folded AS (
  SELECT d.*, coalesce(proof, '') AS proof, list_reduce(list_prepend(given, coalesce(steps, [])),
    lambda f, s: sha256(split_part(s, ':', 1) || f || split_part(s, ':', 2))) AS folded_root
  FROM leaves d LEFT JOIN proofs USING (doc_id))
SELECT f.doc_id, f.leaf, r.subroot, h.node AS root, sha256(f.proof) AS proof_sha256, f.folded_root, f.folded_root = h.node AS verified
FROM folded f JOIN subroots r ON r.lang IS NOT DISTINCT FROM f.lang, high h WHERE h.n = 1
"""


def _inputs(**changed: str) -> str:
    """SQL for the text that a leaf hashes."""
    values = [f"({changed.get(name, name)})::VARCHAR" for name in FIELDS]
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


SQL = SQL.format(_inputs(), _inputs(n_chars="n_chars + 1"))
