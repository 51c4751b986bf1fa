"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens.

Merges never cross a word as :meth:`Pieces.split` cuts it, so a text's count is the sum of its
words' counts. The first tier is a broadcast table of the corpus' frequent words, of at most
``TABLE_SIZE`` entries; the second is each worker's cache of the words it met last, filled by the
tokenizer library. Both only save time: each word's count is the library's.

The frequent words come from all rows. A task counts its own words in bounded space and hands over
one summary, and summaries are merged in two steps, so what is shuffled does not grow with the texts.

Defined cases: a null or empty text has no tokens and no bytes; a null key stays; repeated rows give
repeated results; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import remembered, share, shared, table
from tidemill.llm.pieces import BYTE, Pieces, Recent

TABLE_SIZE = 1 << 16
LIMIT = 4096


class Summary:
    """The frequent words of a stream in bounded space: rare ones are forgotten when it is full."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, words) -> None:
        self.counts.update(words)
        if len(self.counts) > 8 * self.size:
            self.shrink(2 * self.size)

    def shrink(self, size: int) -> None:
        if len(self.counts) > size:
            values = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            least = np.partition(values, -size)[-size]
            above = {w: n for w, n in self.counts.items() if n > least}
            ties = sorted(w for w, n in self.counts.items() if n == least)[: size - len(above)]
            self.counts = Counter(above | dict.fromkeys(ties, int(least)))

    def pack(self) -> bytes:
        self.shrink(self.size)
        numbers = np.fromiter(self.counts.values(), "<i8", len(self.counts)).tobytes()
        words = "\0".join(self.counts).encode()
        return zlib.compress(len(numbers).to_bytes(8, "little") + numbers + words, 1)

    def merge(self, packed: bytes) -> None:
        raw = zlib.decompress(packed)
        size = int.from_bytes(raw[:8], "little")
        if size:
            words = raw[8 + size:].decode().split("\0")
            self.add(dict(zip(words, np.frombuffer(raw[8: 8 + size], "<i8").tolist())))


def _words(model: Pieces, batch: pa.RecordBatch, column: int = 0) -> Iterator[list[str]]:
    for start in range(0, batch.num_rows, 512):
        for text in batch.column(column).slice(start, 512).to_pylist():
            yield model.split(text) if text else []


def frequent_words(docs: DataFrame, model: Pieces, text: str = "text", size: int = TABLE_SIZE) -> list[str]:
    """The ``size`` words that occur most often, as far as summaries of bounded space can tell.

    The driver receives at most 16 summaries of ``size`` words.
    """
    spark = docs.sparkSession
    sent = share(spark, model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, pieces = Summary(size), shared(sent)
        for batch in batches:
            for words in _words(pieces, batch):
                summary.add(w for w in words if len(w) <= 64 and "\0" not in w)
        packed = summary.pack()
        yield pa.RecordBatch.from_pydict({"slot": [zlib.crc32(packed) % 16], "summary": [packed]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in batches:
            for packed in batch.column(1):
                summary.merge(packed.as_py())
        yield pa.RecordBatch.from_pydict({"slot": [0], "summary": [summary.pack()]})

    kind = "slot long, summary binary"
    summaries = docs.select(text).where(F.col(text) != "").mapInArrow(count, kind)
    total = Summary(size)
    for row in summaries.repartition(16, "slot").mapInArrow(merge, kind).toLocalIterator():
        total.merge(row["summary"])
    total.shrink(size)
    return sorted(total.counts)


class Counts:
    """Both tiers in one worker: words to numbers of tokens."""

    def __init__(self, library, frequent: dict[str, int], mark: str):
        self.library, self.mark = library, mark
        self.frequent = frequent
        self.recent = Recent(self._count)

    def _count(self, word: str) -> int:
        known = self.frequent.get(word)
        return len(self.library.encode(self.mark + word)) - 2 if known is None else known

    def total(self, words: list[str]) -> int:
        return sum(map(self.recent.__getitem__, words))


def lengths_of(path: str, model: Pieces, words: list[str]) -> np.ndarray:
    """Numbers of tokens of words by the library.

    A line feed before a word stands for what is before it in a text: it is a token of bytes, merges
    with nothing, and takes the model's own prefix, so the word adds what it adds anywhere.
    """
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    if len(library.encode("\n")) != 2 or model.kinds[library.encode("\n")[1]] != BYTE:
        raise ValueError(f"{path} has a piece with a line feed, or no prefix")
    return np.array([len(ids) - 2 for ids in library.encode(["\n" + w for w in words], num_threads=1)], dtype="<u2")


def count_tokens(
    docs: DataFrame, path: str, frequent: list[str], key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key, n_bytes, n_tokens`` of every row. No shuffle.

    The broadcast holds the words and their lengths in one string and one array, ``TABLE_SIZE``
    words of at most 64 characters each, and the model file.
    """
    model = Pieces.load(path)
    with open(path, "rb") as file:
        content = file.read()
    small = (model, content, "\0".join(frequent), lengths_of(path, model, frequent))
    sent = share(docs.sparkSession, small)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, pieces = counts_of(shared(sent))
        for batch in batches:
            numbers = [counts.total(words) for words in _words(pieces, batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64())], names=[key, "n_bytes", "n_tokens"]
            )

    rows = docs.select(
        F.col(key).cast("long").alias(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("__text"),
    )
    return rows.mapInArrow(run, f"{key} long, n_bytes long, n_tokens long")


def counts_of(small: tuple) -> tuple[Counts, Pieces]:
    """The tiers of this worker, kept from task to task."""
    model, content, words, lengths = small

    def make() -> tuple[Counts, Pieces]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=content)
        frequent = dict(zip(words.split("\0"), lengths.tolist())) if len(lengths) else {}
        return Counts(library, frequent, "\n"), model

    return remembered("token counts", (content, words), make)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents")
    counted = count_tokens(docs, path, frequent_words(docs, Pieces.load(path)))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
