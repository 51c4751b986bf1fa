"""Dense text vectors by seeded sign projections of hashed words, and a similarity join over them.

A word counts in one of 2**18 buckets, by its md5. A text's weights are tf · ln((documents + 1) / (uses + 1)) per
bucket. Element ``i`` of its vector is the sum of the weights, each with the sign that bit ``i`` of the bucket's
own md5 chain gives; the vector is scaled to length 1. So no matrix is stored or sent: any engine with
md5 finds the same vectors, and similar weights give similar vectors.
"""

from __future__ import annotations

import hashlib
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.text import word_bucket, words
from tidemill.operators.chunking import counted
from tidemill.sources.shared import run_dir

# Executors need not have this package: what tasks run travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 18
DIMS = 768
BAND_BITS = 16
WORD_BITS = 64
# Texts that a task projects and hands on at once, and buckets whose signs it adds up at once.
ROWS, AT_ONCE = 256, 2048
# Standard deviations that candidates' differing signs may be beyond their mean, and slopes of the lines that bound that mean.
DEVIATIONS, SLOPES = 8, (0.4, 0.8, 1.2, 2.0, 4.0)
# Bands that one join matches, and the ids of a group of pairs that are scored together.
BANDS_AT_ONCE, TILE = 12, 1024
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def spread(docs: DataFrame) -> DataFrame:
    """``docs`` dealt evenly over the tasks of a shuffle: a file whose rows are one group is else one task's work."""
    return docs.repartition(_tasks(docs.sparkSession))


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What an action in here shuffles leaves the disks when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame``, written to the shared folder and read back: made once for all that read it."""
    spark = frame.sparkSession
    path = run_dir(spark, label)
    with _shuffles_dropped(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bucket(word: Column) -> Column:
    """A word's bucket: the upper 18 bits of the 20 that :func:`word_bucket` has."""
    return F.shiftright(word_bucket(word), 2)


def bag(text: Column) -> Column:
    """``array<struct<word,tf>>`` of a text's buckets and their counts, by bucket; ``word`` is the bucket."""
    return counted(F.transform(words(F.coalesce(text, F.lit(""))), bucket))


def bag_arrays(text: Column) -> Column:
    """:func:`bag` as ``struct<number,tf>`` of two arrays: smaller than the text, whose place it takes in :class:`Embedder`."""
    held = F.transform(F.array(bag(text)), lambda b: F.struct(
        F.transform(b, lambda x: x["word"]).alias("number"), F.transform(b, lambda x: x["tf"].cast("int")).alias("tf"),
    ))
    return held[0]


def same_words(text: Column, bagged: bool = False) -> Column:
    """A digest that texts with the same buckets and counts share: they have the same vector.

    With ``bagged`` it is of a column of :func:`bag_arrays`, and not that of the text.
    """
    if bagged:
        return F.sha2(text.cast("string"), 256)
    named = F.transform(bag(text), lambda b: F.concat(b["word"].cast("string"), F.lit(":"), b["tf"].cast("string")))
    return F.sha2(F.array_join(named, ","), 256)


def _is_bag(docs: DataFrame, column: str) -> bool:
    return isinstance(docs.schema[column].dataType, StructType)


def sign_bytes(number: int, blocks: int) -> bytes:
    """The signs of a bucket, a bit each: md5 of ``bucket:block``, 128 for each block."""
    return b"".join([hashlib.md5(b"%d:%d" % (number, block)).digest() for block in range(blocks)])


class Signs:
    """The signs of the buckets met so far: at most ``BUCKETS`` rows of ``dims / 8`` bytes."""

    def __init__(self, dims: int):
        self.dims, self.blocks = dims, -(-dims // 128)
        self.bits = np.zeros((BUCKETS, self.blocks * 16), np.uint8)
        self.met = np.zeros(BUCKETS, bool)
        self.of_byte = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1.0
        self.first = np.arange(self.blocks * 16) * 256

    def project(self, numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sum of the buckets' signs by their weights: weights are added up by byte, and bytes stand for signs."""
        new = numbers[~self.met[numbers]]
        if len(new):
            told = b"".join([sign_bytes(number, self.blocks) for number in new.tolist()])
            self.bits[new] = np.frombuffer(told, np.uint8).reshape(len(new), -1)
            self.met[new] = True
        wide = len(self.first)
        total = np.zeros(wide * 256)
        for at in range(0, len(numbers), AT_ONCE):
            byte = self.bits[numbers[at: at + AT_ONCE]] + self.first
            total += np.bincount(byte.ravel(), np.repeat(weights[at: at + AT_ONCE], wide), wide * 256)
        return (total.reshape(wide, 256) @ self.of_byte).ravel()[: self.dims]


def _signs(dims: int) -> Signs:
    """The signs that a worker process keeps from task to task."""
    place = sys.modules.setdefault("_tidemill_signs", types.ModuleType("_tidemill_signs")).__dict__
    if place.get("dims") != dims:
        place |= {"dims": dims, "kept": Signs(dims)}
    return place["kept"]


def vectors_of(numbers: pa.ListArray, tfs: pa.ListArray, idf: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of bags, of length 1, and which bags have one; the others' are zero."""
    kept = _signs(dims)
    number, tf = (c.flatten().to_numpy() for c in (numbers, tfs))
    weights = tf * idf[number]
    ends = np.cumsum(tfs.value_lengths().to_numpy()).tolist()
    vectors = np.zeros((len(numbers), dims))
    for i, (start, end) in enumerate(zip([0, *ends[:-1]], ends)):
        vectors[i] = kept.project(number[start:end], weights[start:end])
    lengths = np.linalg.norm(vectors, axis=1)
    told = lengths > 0
    vectors[told] /= lengths[told, None]
    return vectors, told


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` whose last column, one of :func:`bag_arrays`, is packed: what a shuffle of arrays writes has four times the size.

    Steps from bucket to bucket and the counts are written byte by byte: first all low bytes, then the higher ones, which are mostly 0.
    """
    names = docs.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, tf = (batch.columns[-1].field(c) for c in ("number", "tf"))
            ends = np.cumsum(tf.value_lengths().to_numpy()).tolist()
            number, tf = (c.flatten().to_numpy() for c in (number, tf))
            told = []
            for start, end in zip([0, *ends[:-1]], ends):
                values = np.concatenate([np.diff(number[start:end], prepend=0), tf[start:end]]).astype("<u4")
                told.append(zlib.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(told, pa.binary())], names=names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1]]
    return docs.mapInArrow(pack, ", ".join([*kinds, f"`{names[-1]}` binary"]))


def unpacked(held: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
    """The buckets and the counts of packed bags."""
    rows = [np.frombuffer(zlib.decompress(row), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for row in held.to_pylist()]
    offsets = pa.array(np.cumsum([0, *[len(row) // 2 for row in rows]]), pa.int32())
    numbers = np.concatenate([np.cumsum(row[: len(row) // 2]) for row in rows]).astype(np.int32)
    tfs = np.concatenate([row[len(row) // 2:] for row in rows]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(numbers)), pa.ListArray.from_arrays(offsets, pa.array(tfs))


def project(batches: Iterator[pa.RecordBatch], idf: np.ndarray, dims: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches whose last two columns, a text's buckets and their counts, become its vector; ``ROWS`` texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            vectors, told = vectors_of(*part.columns[-2:], idf, dims)
            offsets = np.concatenate([[0], np.cumsum(told * dims)]).astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors[told].ravel()), mask=pa.array(~told))
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], made], names=names)


@dataclass(frozen=True)
class Embedder:
    """Weights of the buckets, at most 2**18 numbers, and the size of the vectors."""

    idf: np.ndarray
    dims: int = DIMS

    def embed(self, docs: DataFrame, *keep: str, text: str = "text", out: str = "vector") -> DataFrame:
        """``<keep>, <out>``: vectors of length 1; null for a text without a word that has weight. No shuffle.

        A task holds the vectors of ``ROWS`` texts at a time. ``text`` may be a column of :func:`bag_arrays`.
        """
        dims = self.dims
        sent = docs.sparkSession.sparkContext.broadcast(self.idf)

        if _is_bag(docs, text):
            held = docs.select(*keep, F.col(text)["number"].alias("__number"), F.col(text)["tf"].alias("__tf"))
        else:
            held = docs.select(*keep, bag(F.col(text)).alias("__b")).select(
                *keep, F.transform("__b", lambda b: b["word"]).alias("__number"), F.transform("__b", lambda b: b["tf"]).alias("__tf"),
            )
        kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
        return held.mapInArrow(lambda batches: project(batches, sent.value, dims, [*keep, out]), f"{kinds}, {out} array<double>")

    def of_bags(self, spark: SparkSession) -> Callable[[pa.Array], np.ndarray]:
        """What makes the vectors of a column of :func:`packed` bags in a task."""
        dims, sent = self.dims, spark.sparkContext.broadcast(self.idf)
        return lambda held: vectors_of(*unpacked(held), sent.value, dims)[0]


def fit_embedder(docs: DataFrame, text: str = "text", dims: int = DIMS) -> Embedder:
    """Weights from all of ``docs``, texts or bags: one row per bucket comes to the driver, at most 2**18."""
    if _is_bag(docs, text):
        uses = docs.select(F.explode(F.col(text)["number"]).alias("number"))
    else:
        met = F.array_distinct(F.transform(words(F.coalesce(text, F.lit(""))), bucket))
        uses = spread(docs.select(text)).select(F.explode(met).alias("number"))
    with _shuffles_dropped(docs.sparkSession):
        rows = uses.groupBy("number").agg(F.count("*").alias("uses")).toArrow()
    documents = docs.count()
    counts = np.zeros(BUCKETS)
    counts[rows["number"].to_numpy()] = rows["uses"].to_numpy()
    return Embedder(np.log((documents + 1) / (counts + 1)), dims)


def _sign_words(vectors: np.ndarray) -> list[np.ndarray]:
    """The signs of vectors as 64-bit numbers; those of a last, shorter word are its lowest bits."""
    told = []
    for at in range(0, vectors.shape[1], WORD_BITS):
        bits = vectors[:, at: at + WORD_BITS] >= 0
        bits = np.pad(bits, ((0, 0), (WORD_BITS - bits.shape[1], 0)))
        told.append(np.packbits(bits, axis=1).view(">i8").astype(np.int64).ravel())
    return told


def _bands(words_: list[Column], dims: int) -> list[Column]:
    """The whole bands of ``BAND_BITS`` signs."""
    lanes = [F.shiftright(w, at).bitwiseAND(F.lit((1 << BAND_BITS) - 1)) for w in words_ for at in range(0, WORD_BITS, BAND_BITS)]
    return lanes[: dims // BAND_BITS]


def most_different(vectors: np.ndarray, least: float) -> np.ndarray:
    """In how many signs a vector of length 1 may differ from one with a cosine of ``least`` or more.

    The other vector is this one, turned by t at most: to element x comes tan(t) z, with z of mean square 1 / size. The sign
    turns if that is larger than x and, one time in two, against it. Of all ways in which z may be spread over the elements, as
    its signs are those of other words, the one that turns most is taken: with G(u) elements whose square is up to u, half of the least
    concave bound of G at tan(t)² / size; any line above G bounds it. ``DEVIATIONS`` are added to that mean.
    """
    dims = vectors.shape[1]
    if least <= 0:
        return np.full(len(vectors), dims, np.int32)
    squares = np.sort(vectors * vectors, axis=1) * dims
    turned = 1 / least**2 - 1
    most = np.full(len(vectors), float(dims))
    for slope in SLOPES:
        above = (np.arange(1, dims + 1) - slope * dims * squares).max(axis=1, initial=0)
        most = np.minimum(most, above + slope * dims * turned)
    share = most / 2 / dims
    return np.minimum(np.ceil(dims * share + DEVIATIONS * np.sqrt(dims * share * (1 - share))), dims).astype(np.int32)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def signed(batches: Iterator[pa.RecordBatch], least: float, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column, a vector, becomes the signs it may differ in and its signs; ``ROWS`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            vectors = _matrix(part.columns[-1])
            told = [most_different(vectors, least), *_sign_words(vectors)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, told)], names=names)


def scored(
    batches: Iterator[pa.RecordBatch], least: float, vectors: Callable[[pa.Array], np.ndarray], names: list[str]
) -> Iterator[pa.RecordBatch]:
    """The pairs of whole tiles with their similarity, from rows ``tile, part, id, other, same, size, held`` by tile and part.

    Rows of part 0 have what ``vectors`` are made of, those of part 1 are the tile's pairs. One tile and a batch are held.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        tiles = batch.column("tile").to_numpy()
        if not len(tiles):
            continue
        cut = int(np.searchsorted(tiles, tiles[-1]))
        if held and (cut or held[-1].column("tile")[-1].as_py() != tiles[-1]):
            yield from _scored(pa.Table.from_batches([*held, batch.slice(0, cut)]), least, vectors, names)
            held = []
        elif cut:
            yield from _scored(pa.Table.from_batches([batch.slice(0, cut)]), least, vectors, names)
        held.append(batch.slice(cut))
    if held:
        yield from _scored(pa.Table.from_batches(held), least, vectors, names)


def _scored(rows: pa.Table, least: float, vectors: Callable[[pa.Array], np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    part = rows["part"].to_numpy()
    own, pairs = (rows.filter(pa.array(part == p)) for p in (0, 1))
    # A class may be in several tiles and its row come twice, but has one vector; a key may be that of several classes.
    first: dict[tuple, int] = {}
    place: dict[tuple, dict] = {}
    for i, (t, k, s) in enumerate(zip(*(own[c].to_pylist() for c in ("tile", "id", "same")))):
        place.setdefault((t, k), {})[s] = first.setdefault((k, s), i)
    met = [
        (i, j) for t, a, b in zip(*(pairs[c].to_pylist() for c in ("tile", "id", "other")))
        for i in place[t, a].values() for j in place[t, b].values()
    ]
    if not met:
        return
    used = np.array(list(first.values()))
    own = own.take(pa.array(used)).combine_chunks()
    made, sizes, ids = vectors(own["held"].combine_chunks()), own["size"].to_numpy(), own["id"].combine_chunks()
    left, right = np.searchsorted(used, np.array(met)).T
    for at in range(0, len(left), AT_ONCE):
        i, j = left[at: at + AT_ONCE], right[at: at + AT_ONCE]
        similarity = np.einsum("ij,ij->i", made[i], made[j])
        kept = similarity >= least
        i, j = i[kept], j[kept]
        arrays = [ids.take(pa.array(i)), ids.take(pa.array(j)), pa.array(similarity[kept]), pa.array(sizes[i]), pa.array(sizes[j])]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _candidates(classes: DataFrame, words_: list[Column], dims: int) -> DataFrame:
    """``left_id, right_id`` of classes that share a band and differ in few signs, each pair once.

    ``BANDS_AT_ONCE`` bands at a time: what a join shuffles is dropped before the next one starts.
    """
    spark = classes.sparkSession
    differ = [F.col(f"left_s{i}").bitwiseXOR(F.col(f"right_s{i}")) for i in range(len(words_))]
    near = reduce(Column.__add__, [F.bit_count(d) for d in differ]) <= F.greatest("left_allowed", "right_allowed")
    held = F.struct(*[d.alias(f"d{i}") for i, d in enumerate(differ)])
    bands = [(b + (k << BAND_BITS)).cast("int") for k, b in enumerate(_bands(words_, dims))]
    found = []
    for at in range(0, len(bands), BANDS_AT_ONCE):
        tables = spread(classes.select("id", "allowed", *words_)).select("*", F.explode(F.array(*bands[at: at + BANDS_AT_ONCE])).alias("band"))
        left, right = (
            tables.select("band", *[F.col(c).alias(f"{s}_{c}") for c in ("id", "allowed")], *[w.alias(f"{s}_s{i}") for i, w in enumerate(words_)])
            for s in ("left", "right")
        )
        pairs = left.join(right, "band").where((F.col("left_id") < F.col("right_id")) & near)
        # Behind explode: with this test too, the join's loop is a method too large to be compiled.
        pairs = pairs.select("left_id", "right_id", "band", F.explode(F.array(held)).alias("d"))
        lanes = _bands([F.col(f"d.d{i}") for i in range(len(words_))], dims)[: at + BANDS_AT_ONCE]
        first = F.array_position(F.array(*lanes), F.lit(0).cast("long")) - 1
        pairs = pairs.where(first == F.shiftright("band", BAND_BITS))
        found.append(written(pairs.select("left_id", "right_id"), "pairs"))
    kind = classes.schema["id"].dataType.simpleString()
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], f"left_id {kind}, right_id {kind}")


def _tiled(pairs: DataFrame) -> DataFrame:
    """``tile, left_id, right_id``: pairs dealt so that a tile's pairs share their vectors.

    A pair's group is the smallest id that its left one is paired with, which is one for all of a cluster. Groups of over
    ``TILE`` ids are cut by both ids' hashes, so no tile has many more than twice that, however large a cluster is.
    """
    both = pairs.union(pairs.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id")))
    lead = both.groupBy("left_id").agg(F.min("right_id").alias("group")).withColumn("group", F.least("group", "left_id"))
    placed = written(pairs.join(lead, "left_id"), "placed")
    members = placed.select("group", F.explode(F.array("left_id", "right_id")).alias("id")).distinct().groupBy("group").agg(F.count("*").alias("n"))
    large = members.where(F.col("n") > TILE).select("group", F.ceil(F.col("n") / TILE).alias("cuts"))
    cut = [F.coalesce(F.pmod(F.xxhash64(c), "cuts"), F.lit(0).cast("long")) for c in ("left_id", "right_id")]
    tile = F.xxhash64("group", *cut).alias("tile")
    return written(placed.join(large, "group", "left").select(tile, "left_id", "right_id"), "tiles")


def similar_pairs(
    vectors: DataFrame, least: float, key: str = "doc_id", vector: str = "vector", same: str = "same", dims: int = DIMS,
    source: DataFrame | None = None, made: Callable[[pa.Array], np.ndarray] = _matrix,
) -> DataFrame:
    """Pairs of different texts with cosine of at least ``least``: ``left_id, right_id, similarity, left_size, right_size``.

    ``vectors`` have length 1, and rows with one ``same`` have one vector: such a class is one row here, named by
    its smallest key, with its size, so copies are never paired. Candidates meet in hash tables: the signs of
    a vector are cut in bands of ``BAND_BITS``, and a pair is made in the first band that both share, once.
    A pair at 0.9 shares none of 48 bands with a chance of 1.5 %, at 0.95 of 6 in 100,000. Only ids, bands and signs, a
    bit each, go through the tables, ``BANDS_AT_ONCE`` bands at a time. A pair leaves the join if it differs in more signs than
    :func:`most_different` tells, which loses one in 10**11 at 0.95. The pairs that are left are scored in tiles: a vector is
    sent to a tile once, not to each of its pairs.

    Vectors are large beside their texts. They are written once, or not at all where ``source`` is given: its columns are ``key,
    same`` and what ``made`` makes the same vectors of in a task, such as :func:`packed` bags.
    """
    rows = vectors.where(F.col(vector).isNotNull()).select(key, same, vector)
    if source is None:
        rows = source = written(rows, "vectors")
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (key, same)}
    words_ = [f"s{i}" for i in range(-(-dims // WORD_BITS))]
    told = rows.mapInArrow(
        lambda batches: signed(batches, least, [key, same, "allowed", *words_]),
        ", ".join([*[f"`{c}` {k}" for c, k in kinds.items()], "allowed int", *[f"{w} long" for w in words_]]),
    )
    held = [F.first(c).alias(c) for c in ("allowed", *words_)]
    classes = written(told.groupBy(F.col(same).alias("same")).agg(F.min(key).alias("id"), F.count("*").alias("size"), *held), "classes")
    pairs = _tiled(_candidates(classes, [F.col(w) for w in words_], dims))
    asked = pairs.select("tile", F.explode(F.array("left_id", "right_id")).alias("id")).distinct()
    asked = asked.join(classes.select("id", "same", "size"), "id")
    source = source.toDF("__k", "__s", "held")
    own = asked.join(source, (F.col("id") == F.col("__k")) & F.col("same").eqNullSafe(F.col("__s")))
    own = own.select("tile", F.lit(0).alias("part"), "id", F.lit(None).cast(kinds[key]).alias("other"), "same", "size", "held")
    lines = pairs.select("tile", F.lit(1).alias("part"), F.col("left_id").alias("id"), F.col("right_id").alias("other"), *[
        F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("same", "size", "held")
    ])
    names = ["left_id", "right_id", "similarity", "left_size", "right_size"]
    return own.union(lines).repartition(_tasks(vectors.sparkSession), "tile").sortWithinPartitions("tile", "part").mapInArrow(
        lambda batches: scored(batches, least, made, names),
        f"left_id {kinds[key]}, right_id {kinds[key]}, similarity double, left_size long, right_size long",
    )
