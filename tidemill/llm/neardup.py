"""Near copies by a multi-index Hamming join of MinHash signatures.

A document's set is its distinct shingles of five words. Its signature is ``CHUNKS`` chunks of
``WIDTH`` MinHash values of 12 bits, a chunk to a 64-bit number, and the distance of two signatures is the number of values that
differ. If at most ``CHUNKS * (ERRORS + 1) - 1`` differ (23 of 60), some chunk differs in ``ERRORS``
values or fewer; so a chunk is entered once for each way to leave ``ERRORS`` values out, and all
pairs under that distance share an entry. Pairs beyond it are found by chance too: a pair of
similarity 0.75 shares no entry with a probability of (1 - 0.6328)**12, about 6 in a million.

What shares an entry is confirmed on full sets. Entries are never expanded into pairs while they
hold one component. Documents of equal sets are one node. In some rounds each node tests one
neighbour, of those that hashes pick for its entries the one most like it by their sketches, and links are
contracted; a crowd of near copies is one component after that, at a cost of a test per node and round. Then, in entries that still hold
several components, every row outside the largest meets all rows of other components, so no pair is
left out. A pair whose signatures or sizes rule the similarity out does not leave the join, and any
other leaves it in one entry only, the first that it shares.

Defined cases: a null text, or one without words, has an empty set, and is linked with nothing; with
fewer than five words the whole sequence is the one shingle; rows with equal texts are in one
component, whatever their ids, and so are rows that repeat; a row without an id is linked with rows of
an equal set only, and never names a component that has an id; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import fan_out, forget, table, written
from tidemill.llm.graph import components

SHINGLE = 5
PERCENT = 75
CHUNKS, WIDTH, ERRORS = 12, 5, 1
VALUES = CHUNKS * WIDTH
BITS = 12
# Signatures of pairs at the threshold differ in 15 values, with a deviation of 3.35; in more than 30
# with a probability of 8 in a million.
MOST_DIFFERENT = 30
ODD = 1024
ROUNDS = 3
MOST_SENT = 1 << 20

_random = np.random.default_rng(20)
_odd = lambda n: _random.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES, FACTORS, SHIFTS = _odd(SHINGLE), _odd(VALUES), _odd(VALUES)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < SHINGLE:
        return _mixed((hashes * PLACES[: len(words)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(words)))
    many = len(words) - SHINGLE + 1
    sums = hashes[:many] * PLACES[0]
    for i in range(1, SHINGLE):
        sums += hashes[i: i + many] * PLACES[i]
    return np.unique(_mixed(sums))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``CHUNKS`` numbers of ``WIDTH`` MinHash values each."""
    least = np.full(VALUES, 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), 1024):
        hashed = (shingles[None, start: start + 1024] ^ SHIFTS[:, None]) * FACTORS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    values = (_mixed(least) >> np.uint64(64 - BITS)).reshape(CHUNKS, WIDTH)
    return (values << _LANES).sum(axis=1, dtype=np.uint64).view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parities of ``ODD`` bits as 64-bit numbers."""
    parity = np.bincount((shingles >> np.uint64(64 - ODD.bit_length() + 1)).astype(np.int64), minlength=ODD) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


_LANES = np.arange(WIDTH, dtype=np.uint64) * np.uint64(BITS)


def entries(signatures: np.ndarray) -> np.ndarray:
    """The entries of signatures (rows): every chunk, with each of its values left out once."""
    left_out = ~(np.uint64(2**BITS - 1) << _LANES)
    places = (np.arange(CHUNKS * WIDTH, dtype=np.uint64).reshape(CHUNKS, WIDTH) + np.uint64(1)) << np.uint64(52)
    chunks = signatures.view(np.uint64)[:, :, None] & left_out
    return _mixed(_mixed(chunks) + places).reshape(len(signatures), -1)


_LOW = sum((2 ** (BITS - 1) - 1) << BITS * j for j in range(WIDTH))
_TOP = sum(2 ** (BITS - 1) << BITS * j for j in range(WIDTH))


def _apart(a: str, b: str, chunk: int) -> Column:
    return F.col(f"{a}{chunk}").bitwiseXOR(F.col(f"{b}{chunk}"))


def _differ(chunk: Column) -> Column:
    """How many values differ in a chunk, given the exclusive or of both.

    Adding all ones to the lower bits of each value carries into its top bit unless they are zero.
    """
    return F.bit_count((chunk.bitwiseAND(F.lit(_LOW)) + F.lit(_LOW)).bitwiseOR(chunk).bitwiseAND(F.lit(_TOP)))


def _chunks(side: str, columns: list[str]) -> list[Column]:
    """A signature, and an odd sketch if there is one, as columns: a join tests millions of pairs, and plain numbers
    keep its code small."""
    at = lambda name, c: F.coalesce(F.get(name, F.lit(c)), F.lit(0).cast("long")).alias(f"{name}_{side}{c}")
    odd = [at("odd", c) for c in range(ODD // 64)] if "odd" in columns else []
    return [*[at("sig", c) for c in range(CHUNKS)], *odd]


def _may_link(a: str, b: str, columns: list[str]) -> Column:
    """Whether sizes ``n_``, signatures ``sig_`` and, if there are any, odd sketches ``odd_`` allow the similarity.

    Sketches never lose a link: with 75 % of the union common, sets differ in a seventh of both sizes.
    """
    sizes = 100 * F.least(f"n_{a}", f"n_{b}") >= PERCENT * F.greatest(f"n_{a}", f"n_{b}")
    if "odd" in columns:
        bits = reduce(Column.__add__, [F.bit_count(_apart(f"odd_{a}", f"odd_{b}", c)) for c in range(ODD // 64)])
        sizes &= bits * (100 + PERCENT) <= (100 - PERCENT) * (F.col(f"n_{a}") + F.col(f"n_{b}"))
    distance = reduce(Column.__add__, [_differ(_apart(f"sig_{a}", f"sig_{b}", c)) for c in range(CHUNKS)])
    return sizes & (distance <= MOST_DIFFERENT)


def _first_shared(a: str, b: str, slot: Column) -> Column:
    """Whether a shared entry is the first that both sides share.

    No chunk before it may be within the allowed errors. Within the chunk, all entries are shared if no
    value differs, and else only the one that leaves the differing value out.
    """
    before = [(slot < (c + 1) * WIDTH) | (_differ(_apart(a, b, c)) > ERRORS) for c in range(CHUNKS - 1)]
    equal = [(slot < c * WIDTH) | (slot >= (c + 1) * WIDTH) | (_apart(a, b, c) != 0) for c in range(CHUNKS)]
    return reduce(Column.__and__, before) & ((slot % WIDTH == 0) | reduce(Column.__and__, equal))


SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("sig", pa.list_(pa.int64())), ("odd", pa.list_(pa.int64())),
])


def signed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", sketched: bool = False) -> DataFrame:
    """``doc_id, n_shingles, node, sig`` and, if ``sketched``, ``odd``; ``node`` is a hash of the whole set, null for
    an empty one."""
    schema = pa.schema(list(SIGNED)[: 5 if sketched else 4])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes, nodes, signatures, sketches = [], [], [], []
                for content in part.column(1).to_pylist():
                    found = shingle_set(content)
                    sizes.append(len(found))
                    nodes.append(xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63 if len(found) else None)
                    signatures.append(signature(found) if len(found) else None)
                    if sketched:
                        sketches.append(odd_sketch(found) if len(found) else None)
                columns = [pa.array(c, f.type) for c, f in zip((sizes, nodes, signatures, sketches), list(schema)[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, node long, sig array<long>" + ", odd array<long>" * sketched)


def index_entries(nodes: DataFrame) -> DataFrame:
    """``entry, slot, node``: the rows of the multi-index; the slot is the chunk and the value left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                if part.num_rows:
                    found = entries(part.column(1).flatten().to_numpy().reshape(-1, CHUNKS))
                    node = np.repeat(part.column(0).to_numpy(), found.shape[1])
                    slot = np.tile(np.arange(found.shape[1], dtype=np.int32), part.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.ravel().view(np.int64)), pa.array(slot), pa.array(node)], names=["entry", "slot", "node"]
                    )

    return nodes.select("node", "sig").mapInArrow(run, "entry long, slot int, node long")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the nodes in ``wanted`` (``node, doc_id``), from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                nodes, sets = [], []
                for node, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = shingle_set(content)
                    # Rows that share an id may have other texts: only the node's own set counts.
                    if len(found) and xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63 == node:
                        nodes.append(node)
                        sets.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
                )

    # Texts are shuffled only where the wanted ids are too many to be sent to all of them.
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, "doc_id").select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are links: 100 * intersection >= 75 * union, on full sets. Other columns are kept."""
    pairs = written(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(ends.join(nodes.select("node", "doc_id"), "node"), "ends")
    # Several rows may have a node's text: one set each.
    sets = sets_of(docs, wanted).dropDuplicates(["node"])
    left, right = (sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab")
    # The union is both sizes less what is common; told without it, so that sets are intersected once a pair.
    common, both = F.size(F.array_intersect("set_a", "set_b")).cast("long"), F.size("set_a").cast("long") + F.size("set_b")
    return pairs.join(left, "a").join(right, "b").where((100 + PERCENT) * common >= PERCENT * both).select(*pairs.columns)


def _shared(rows: DataFrame) -> DataFrame:
    """Of ``entry, node, component``, the rows of entries that hold several components."""
    mixed = rows.groupBy("entry").agg(F.min("component").alias("__least"), F.max("component").alias("__most"))
    return rows.join(mixed.where("__least <> __most").select("entry"), "entry")


def _renamed(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``rows`` after components were joined as ``named`` (``node, component``, of component names)."""
    moved = named.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    return rows.join(moved, "component", "left").withColumn("component", F.coalesce("__to", "component")).drop("__to")


def _met(rows: DataFrame, step: int) -> DataFrame:
    """``a, b, of_a, of_b``: every node with the leaders of other components in its entries, and the components of both.

    An entry's leader is its row with the smallest hash, another one in each chunk and round: entries of a chunk
    that hold the same rows have the same leader.
    """
    place = F.xxhash64(F.floor(F.col("slot") / F.lit(WIDTH)), "node", F.lit(step)).alias("place")
    leaders = rows.groupBy("entry").agg(F.min(F.struct(place, "node", "component")).alias("__l"))
    leaders = leaders.select("entry", F.col("__l.node").alias("b"), F.col("__l.component").alias("of_b"))
    met = rows.join(leaders, "entry").where("component <> of_b")
    return met.select(F.col("node").alias("a"), "b", F.col("component").alias("of_a"), "of_b").distinct()


def _picked(rows: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """One pair for each node that meets a leader of another component, as :func:`_met` has them: the leader most like
    it, as sketches tell, of those that sizes, signatures and sketches allow to be linked."""
    met = _met(rows, step)
    for side in "ab":
        met = met.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "sig", "odd")]), side)
    apart = lambda name, c: F.get(f"{name}_a", F.lit(c)).bitwiseXOR(F.get(f"{name}_b", F.lit(c)))
    bits = reduce(Column.__add__, [F.bit_count(apart("odd", c)) for c in range(ODD // 64)])
    distance = reduce(Column.__add__, [_differ(apart("sig", c)) for c in range(CHUNKS)])
    both = F.col("n_a") + F.col("n_b")
    allowed = (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")) & (distance <= MOST_DIFFERENT)
    told = met.where(allowed).select("a", "b", "of_a", "of_b", both.alias("both"), bits.alias("bits"))
    # As in _may_link: sketches never lose a link.
    told = told.where(F.col("bits") * (100 + PERCENT) <= (100 - PERCENT) * F.col("both"))
    alike = ((F.col("both") - F.col("bits")) / (F.col("both") + F.col("bits"))).alias("alike")
    best = told.groupBy("a", "of_a").agg(F.max(F.struct(alike, "b", "of_b")).alias("__b"))
    return best.select("a", F.col("__b.b").alias("b"), "of_a", F.col("__b.of_b").alias("of_b"))


def _across(rows: DataFrame, nodes: DataFrame, components: bool = False) -> DataFrame:
    """Every pair ``a, b`` of nodes that share an entry, are of different components, and may be linked; and, if asked
    for, their components ``of_a, of_b``.

    One of them is outside the entry's largest component, so only such rows are joined with all.
    """
    counts = rows.groupBy("entry", "component").agg(F.count("*").alias("__n"))
    largest = counts.groupBy("entry").agg(F.max(F.struct("__n", "component")).alias("__top"))
    outside = F.col("component") != F.col("__top.component")
    told = [c for c in ("n", "sig", "odd") if c in nodes.columns]
    every = rows.join(largest, "entry").join(nodes.select("node", *told), "node")
    every = every.select("entry", "slot", "node", "component", *told, outside.alias("outside"))
    names = ("node", "component", "n", "outside")
    left = every.where("outside").select("entry", "slot", *[F.col(c).alias(f"{c}_a") for c in names], *_chunks("a", told))
    right = every.select("entry", *[F.col(c).alias(f"{c}_b") for c in names], *_chunks("b", told))
    # Rows outside meet from both sides: once is enough.
    once = ~F.col("outside_b") | (F.col("node_b") < F.col("node_a"))
    other = F.col("component_a") != F.col("component_b")
    kept = other & once & _may_link("a", "b", told) & _first_shared("sig_a", "sig_b", F.col("slot"))
    of = [F.col(f"component_{side}").alias(f"of_{side}") for side in "ab"] if components else []
    return left.join(right, "entry").where(kept).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), *of)


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row: the smallest id reachable by links, and
    whether it is the row's own."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = written(signed_documents(docs, sketched=True), "signed")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("odd").alias("odd")
    )
    nodes = written(nodes, "nodes")
    # A node has 60 entries: dealt over all tasks, else the few tasks that read the nodes hold all entries at once.
    index = index_entries(nodes.select("node", "sig").repartition(fan_out(docs.sparkSession), "node"))
    rows = written(_shared(index.withColumn("component", F.col("node"))), "entries")
    names = nodes.select("node", F.col("node").alias("component"))
    named = nodes.where("doc_id IS NOT NULL")
    for step in range(rounds + 1):
        pairs = _picked(rows, named, step) if step < rounds else _across(rows, named, components=True)
        links = confirmed(pairs, named, docs).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        joined = written(components(links), "components")
        names = _renamed(names, joined)
        if step < rounds:
            rows = written(_shared(_renamed(rows, joined)), "entries")
    names = written(names, "names")
    smallest = names.join(nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = names.join(smallest, "component").select("node", "component_id")
    found = signed.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op9_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
r AS (
  SELECT doc_id AS node, doc_id AS reached FROM documents
  UNION SELECT l.a, r.reached FROM r JOIN l ON l.b = r.node),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
