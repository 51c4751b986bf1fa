"""Best-fit packing of documents into sequences, repacked until a lower bound certifies it.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt to partitions of bounded
size by a hash and packed there by best fit in decreasing order. Dual-feasible functions of the
piece lengths give a number of sequences that no packing can go under; a partition that reaches its
bound is done. The documents of the others are dealt again, to other neighbours and larger
partitions, and packed again, as long as that saves sequences.

Defined cases: a null or empty text is a document of one token, the end mark; a null id is kept;
repeated rows are packed like any others; ties are broken by id, piece and checksum; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Rows, remembered, table, written

CAPACITY = 1024
END_ID = 2
GROUP_ROWS = 8192
ROUNDS = 4


# How byte-level tokenizers cut texts, and the bytes that stand for themselves in their files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


class ByteTokens:
    """Ids of a byte-level tokenizer file in one worker, as 32-bit numbers in one string.

    The file's vocabulary and its special strings are given to the faster of two public libraries,
    which gives the same ids as long as ids rise with the order of merges; the file is refused if
    they do not. A text that this library gives up on is encoded by the file's own library.
    """

    def __init__(self, content: str):
        import tiktoken

        self.content = content
        file = json.loads(content)
        ids, steps = file["model"]["vocab"], file["pre_tokenizer"]
        merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in file["model"]["merges"]]
        plain = steps["type"] == "ByteLevel" and not steps["add_prefix_space"] and steps.get("use_regex", True)
        if not plain or file["normalizer"] or sorted(merged) != merged:
            raise ValueError("not a plain byte-level tokenizer")
        others = [b for b in range(256) if b not in PRINTABLE]
        byte_of = {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in ids.items() if t not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except (ValueError, OverflowError, RuntimeError):
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(self.content)
            library.no_truncation()
            library.no_padding()
            return np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and the end mark.

    Only documents of more than ``capacity`` ids are cut; their first piece takes the remainder.
    """
    with open(path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = remembered("byte tokens", sent.value, lambda: ByteTokens(sent.value))
        out = Rows(PIECES)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                encoded = [tokens.encode(t) if t else b"" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encoded):
                    ids += end
                    size = len(ids) // 4
                    stop = size % capacity or capacity if size > capacity else size
                    start = piece = 0
                    while start < size:
                        out.add(doc, piece, start, stop - start, zlib.crc32(ids[4 * start: 4 * stop]))
                        start, stop, piece = stop, stop + capacity, piece + 1
                yield from out.full()
        yield out.take()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text")).mapInArrow(run, PIECES_DDL)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """A number of sequences that no packing of ``lengths`` goes under, by dual-feasible functions.

    Such a function maps lengths so that what fits in a sequence still does; then the mapped total,
    in sequences, is a bound. Used are the identity with lengths near full made full and as short
    ones dropped, at every limit, and the rounding functions of 1 to 32 steps.
    """
    if not len(lengths):
        return 0
    size = np.arange(capacity + 1, dtype=np.int64)
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    limits = np.arange(0, capacity // 2 + 1)[:, None]
    raised = np.where(size > capacity - limits, capacity, np.where(size < limits, 0, size))
    best = int(-(-(raised @ count) // capacity).max())
    for steps in range(1, 33):
        product = (steps + 1) * size
        # In units of 1 / (steps * capacity) of a sequence.
        mapped = np.where(product % capacity == 0, size * steps, product // capacity * capacity)
        best = max(best, int(-(-(mapped @ count) // (steps * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and place of each of the ``lengths``, which must be in decreasing order.

    Sequences are kept by free space, and the used spaces in the bits of one number, so the fullest
    sequence that a piece fits in is the lowest bit at or above its length.
    """
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = sequences = 0
    where, place = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        fitting = bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = free[space].pop()
            if not free[space]:
                bits ^= 1 << space
        else:
            sequence, space = sequences, capacity
            sequences += 1
        where[i], place[i] = sequence, capacity - space
        if space > length:
            free[space - length].append(sequence)
            bits |= 1 << space - length
    return where, place, sequences


PACKED_DDL = PIECES_DDL + ", part int, sequence long, offset long, used long, least long"


def _pack_parts(pieces: DataFrame, parts: int, round_: int, capacity: int) -> DataFrame:
    """Deal pieces to ``parts`` partitions and pack each; ``used`` and ``least`` are the partition's
    number of sequences and its lower bound."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = rows.column("length").to_numpy()
        where, place, used = best_fit_decreasing(lengths, capacity)
        n = len(lengths)
        least = lower_bound(lengths, capacity)
        for name, values in (("sequence", where), ("offset", place), ("used", np.full(n, used)), ("least", np.full(n, least))):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows

    # By seeded chance, not by key: repeated rows must spread. A table's rows draw the same numbers each time.
    part = F.floor(F.rand(round_) * parts).cast("int")
    return pieces.select(*PIECES.names, part.alias("part")).groupBy("part").applyInArrow(pack, PACKED_DDL)


def _used(packed: DataFrame) -> int:
    parts = packed.groupBy("part").agg(F.max("used").alias("used"))
    return parts.agg(F.coalesce(F.sum("used"), F.lit(0))).first()[0]


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` should be a table, as it is read twice."""
    numbered = lambda packed, round_: packed.select(
        *PIECES.names, (F.lit(round_ << 56) + F.col("part").cast("long") * (1 << 32) + F.col("sequence")).alias("sequence_id"), "offset"
    )
    packed = written(_pack_parts(pieces, max(1, -(-pieces.count() // group_rows)), 0, capacity), "packed")
    done = []
    for round_ in range(1, rounds + 1):
        done.append(numbered(packed.where("used = least"), round_ - 1))
        gaps = packed.where("used > least")
        n, used = gaps.count(), _used(gaps)
        parts = max(1, -(-n // (group_rows << round_)))
        if not n or round_ == rounds:
            break
        again = written(_pack_parts(gaps, parts, round_, capacity), "packed")
        if _used(again) >= used:
            break
        packed = again
    done.append(numbered(gaps, round_ - 1))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut and pack whole documents."""
    return pack_pieces(written(cut_documents(docs, path, capacity, END_ID, key, text), "pieces"), capacity)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
