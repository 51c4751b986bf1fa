"""Near copies by SimHash fingerprints, found through a Golay code.

A document's fingerprint has 64 bits: a bit is set if more than half of the hashes of its shingles of
four words, repeats included, have it. Documents are linked where at most ``MOST`` bits differ.

Links are found by exact keys. The binary Golay code of length 23 is perfect: every word of 23 bits is
within 3 bits of one codeword. The keys of a word are the indices of the codewords that it, or a word
one bit from it, decodes to: one or six of them. Two words that differ in two bits are both one bit from
a third, so words within two bits share a key. A fingerprint is cut into segments of 22, 21 and 21 bits.
If four bits or fewer differ, then either no segment differs in more than two, and the fingerprints share a
key in each segment; or one segment differs in three or more, and of the other two one is equal and one
differs in at most one bit. So a fingerprint is entered under every triple of keys, and under each segment
with each key of another one: 182 entries on average, of 34 bits or more, and no pair under the distance is missed.

Equal fingerprints are one node. A count, the least, the greatest and the exclusive or of an entry's nodes
name all of them if they are three or fewer, which most shared entries have: these are tested without a
join. The rows of the others are read once more. In some rounds every node
of an entry is tested against the one that a mask picks, and links are contracted, so that a crowd of near
copies becomes one component without ever being paired. Then, in entries that still hold several
components, rows outside the largest meet all rows of other components. Every pair is verified inside the
join, so only links leave it.

Defined cases: a null text, or one without words, has fingerprint zero, which is linked like any
other; with fewer than four words the whole sequence is the one shingle; rows without an id are linked
like any other and name no component that has an id; rows that repeat are in one component; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table, written
from tidemill.llm.graph import components

SHINGLE = 4
SEED = 42
MOST = 4
ROUNDS = 2
MOST_SENT = 1 << 20
# Where segments start, and how many bits they have.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MASKS = (0, -1)

# The generator polynomial of the binary Golay code, its length and its check bits.
GENERATOR, LENGTH, CHECKS = 0b110001110101, 23, 11


def _remainder(word: int) -> int:
    for bit in reversed(range(CHECKS, LENGTH)):
        if word >> bit & 1:
            word ^= GENERATOR << bit - CHECKS
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the upper bits; for each remainder the error of three bits or fewer, and how the
    indices of the neighbours' codewords differ from the word's own; and their number."""
    upper = np.array([_remainder(m << CHECKS) for m in range(1 << LENGTH - CHECKS)], np.int64)
    error = np.zeros(1 << CHECKS, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << b for b in bits)
            error[_remainder(word)] = word
    others = np.zeros((1 << CHECKS, 6), np.int64)
    many = np.zeros(1 << CHECKS, np.int64)
    for check, word in enumerate(error.tolist()):
        near = [word, *[word ^ 1 << b for b in range(LENGTH)]]
        found = sorted({(w ^ int(error[_remainder(w)])) >> CHECKS for w in near})
        others[check, : len(found)], many[check] = found, len(found)
    return upper, error, others, many


UPPER, ERROR, OTHERS, MANY = _tables()


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six places for the keys of each word of 23 bits, and which of them are taken."""
    check = UPPER[words >> CHECKS] ^ (words & ((1 << CHECKS) - 1))
    own = (words ^ ERROR[check]) >> CHECKS
    return own[:, None] ^ OTHERS[check], np.arange(6) < MANY[check][:, None]


def entries(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each entry of some fingerprints, and the place of its fingerprint among them."""
    parts = [(prints.view(np.uint64) >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    held = [keys(part) for part in parts]
    (a, in_a), (b, in_b), (c, in_c) = held
    rows = np.broadcast_to(np.arange(len(prints))[:, None], (len(prints), 216))
    triples = (a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :]).reshape(-1, 216)
    taken = (in_a[:, :, None, None] & in_b[:, None, :, None] & in_c[:, None, None, :]).reshape(-1, 216)
    found, of = [triples[taken]], [rows[taken]]
    for i, part in enumerate(parts):
        for j, (own, there) in enumerate(held):
            if i != j:
                found.append(((1 + 3 * i + j) << 40 | part[:, None] << 12 | own)[there])
                of.append(rows[:, :6][there])
    return np.concatenate(found), np.concatenate(of)


def fingerprint(text: str | None) -> int:
    """The fingerprint of a text, as a signed number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    ends = (ends[width - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        shingles = [line[s:e] for s, e in zip(starts[at: at + (1 << 16)], ends[at: at + (1 << 16)])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # A byte holds the sum of 255 bits.
        counts += np.add.reduceat(bits, range(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, node``: the fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                prints = [fingerprint(content.as_py()) for content in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.int64())], names=["doc_id", "node"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return rows.mapInArrow(run, "doc_id long, node long")


def index_entries(nodes: DataFrame) -> DataFrame:
    """``entry, node``: the index of the fingerprints in ``nodes``, which are distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                prints = batch.column(0).slice(at, 256).to_numpy()
                found, of = entries(prints)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(prints[of])], names=["entry", "node"])

    return nodes.select("node").mapInArrow(run, "entry long, node long")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _few(rows: DataFrame) -> DataFrame:
    """Rows to join with: sent to all tasks where they are few."""
    return F.broadcast(rows) if rows.count() <= MOST_SENT else rows


def _moved(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``rows`` after components were joined as ``joined`` (``node, component``, of component names)."""
    to = joined.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    return rows.join(to, "component", "left").withColumn("component", F.coalesce("__to", "component")).drop("__to")


def _led(rows: DataFrame, mask: int) -> DataFrame:
    """Links ``a, b`` of components: each row against the row of its entry with the smallest masked node."""
    masked = F.col("node").bitwiseXOR(F.lit(mask))
    leaders = rows.groupBy("entry").agg(F.min(F.struct(masked.alias("m"), "node", "component")).alias("__l"))
    leaders = leaders.select("entry", F.col("__l.node").alias("leader"), F.col("__l.component").alias("b"))
    linked = (F.col("component") != F.col("b")) & (_apart("node", "leader") <= MOST)
    return rows.join(leaders, "entry").where(linked).select(F.col("component").alias("a"), "b").distinct()


def _across(rows: DataFrame) -> DataFrame:
    """All links ``a, b`` of components that share an entry: rows outside an entry's largest component meet the rest."""
    counts = rows.groupBy("entry", "component").agg(F.count("*").alias("__n"))
    held = counts.groupBy("entry").agg(F.max(F.struct("__n", "component")).alias("__top"), F.count("*").alias("__held"))
    every = rows.join(held.where("__held > 1").select("entry", "__top"), "entry")
    every = every.select("entry", "node", "component", (F.col("component") != F.col("__top.component")).alias("outside"))
    left = every.where("outside").select("entry", F.col("node").alias("node_a"), F.col("component").alias("a"))
    right = every.select("entry", F.col("node").alias("node_b"), F.col("component").alias("b"), "outside")
    once = ~F.col("outside") | (F.col("node_b") < F.col("node_a"))
    linked = (F.col("a") != F.col("b")) & once & (_apart("node_a", "node_b") <= MOST)
    return left.join(right, "entry").where(linked).select("a", "b").distinct()


def _listed(shared: DataFrame) -> DataFrame:
    """All links ``a, b`` of entries with two or three nodes, which the entry's sums name."""
    third = F.when(F.col("n") == 3, F.col("every").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b"))).otherwise(F.col("a"))
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    pairs = shared.select("a", "b", third.alias("c")).select(
        F.inline(F.array(pair(F.col("a"), F.col("b")), pair(F.col("a"), F.col("c")), pair(F.col("b"), F.col("c"))))
    )
    return pairs.where((F.col("a") != F.col("b")) & (_apart("a", "b") <= MOST)).distinct()


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, node, component_id`` of every row: its fingerprint, and the smallest id reachable by links."""
    signed = written(fingerprints(docs, key, text), "fingerprints")
    nodes = written(signed.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    index = index_entries(nodes)
    # A node has an entry once.
    sums = index.groupBy("entry").agg(
        F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.bit_xor("node").alias("every")
    )
    shared = written(sums.where("n > 1"), "shared")
    joined = written(components(_listed(shared.where("n <= 3"))), "components")
    names = written(_moved(nodes.select("node", F.col("node").alias("component")), joined), "names")
    crowded = _few(shared.where("n > 3").select("entry"))
    rows = written(index.join(crowded, "entry", "left_semi").join(names, "node"), "entries")
    for step in range(rounds + 1):
        links = _led(rows, MASKS[step % len(MASKS)]) if step < rounds else _across(rows)
        joined = written(components(links), "components")
        names = written(_moved(names, joined), "names")
        if step < rounds:
            rows = written(_moved(rows, joined), "entries")
    smallest = names.join(nodes, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = names.join(smallest, "component").select("node", "component_id")
    return signed.join(of_node, "node").select("doc_id", "node", "component_id")


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"), "component_id")
