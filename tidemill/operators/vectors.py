"""Class centroids, outliers, exact and approximate nearest vectors, grounded answers.

Tables have a long id, ``array<float>`` vectors of one dimension, and optionally a class label.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.vector_math import dot, euclidean

MAX_RESULTS = 100
MAX_QUERIES = 1000
HASHES = 4
# Tasks whose winners are merged at once.
FAN_IN = 256
# An index: most lists it may have, rows per list it aims at, rows its lists are fitted on, and how many
# candidates by code are scored exactly for each result asked for.
MOST_LISTS = 4096
LIST_SIZE = 1000
FITTED_ON = 20_000
KEEP = 5


def vector_dims(df: DataFrame, vector: str) -> DataFrame:
    """Rows per vector length: one row when the table is sound."""
    return df.groupBy(F.size(vector).alias("dim")).agg(F.count("*").alias("n"))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Element-wise mean per class, and the class size; vectors are never exploded."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(label).agg(mean.alias("__m"), F.count("*").alias("class_size")).select(
        label, vector_to_array("__m").alias("centroid"), "class_size"
    )


def centroid_distances(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Each row's distance to the centroid of its own class.

    A plain join: rows are read once for it, and adaptive execution sends the centroids to all rows
    where they are few, or splits a hot class where they are many.
    """
    joined = df.join(centroids(df, label, vector), label)
    return joined.select(*df.columns, euclidean(F.col(vector), F.col("centroid")).alias("distance"))


def outliers(distances: DataFrame, radius: float) -> DataFrame:
    """Rows strictly farther than ``radius``."""
    return distances.where(F.col("distance") > radius)


def radius_range(start: int, stop: int, step: int) -> list[float]:
    """Radii in hundredths, free of float drift."""
    return [r / 100 for r in range(start, stop, step)]


def outlier_sweep(distances: DataFrame, radii: Sequence[float]) -> DataFrame:
    """Number of outliers at each radius: one pass with one sum per radius."""
    counts = distances.agg(
        *[F.coalesce(F.sum((F.col("distance") > r).cast("long")), F.lit(0)).alias(f"r{i}") for i, r in enumerate(radii)]
    )
    rows = F.array(*[F.struct(F.lit(r).alias("radius"), F.col(f"r{i}").alias("n_outliers")) for i, r in enumerate(radii)])
    return counts.select(F.inline(rows))


def query_batch(queries: DataFrame, limit: int = MAX_QUERIES) -> list[tuple[int, list[float]]]:
    """The ``(query_id, vector)`` rows of one request; more than ``limit`` is an error, not a cut."""
    rows = queries.select("query_id", "vector").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"at most {limit} queries per request; send them in several requests")
    return [(r["query_id"], r["vector"]) for r in rows]


def nearest(
    corpus: DataFrame,
    queries: Sequence[tuple[int, Sequence[float]]],
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Exact top ``k`` by cosine for each query: ``query_id, rank, <key>, score``.

    Scores are rounded to 6 places and ties go to the smaller key. Vectors without direction never
    match. Each task scores its rows in one matrix product per Arrow batch and keeps ``k`` per
    query, so only winners are shuffled. Filter ``corpus`` first to search a part of it.
    """
    if not 1 <= k <= MAX_RESULTS:
        raise ValueError(f"k must be 1 to {MAX_RESULTS}")
    if not queries:
        empty = corpus.sparkSession.createDataFrame([], f"query_id long, {key} long, score double")
        return _rank(empty, k, key)
    ids = np.array([q for q, _ in queries], dtype=np.int64)
    matrix = np.array([v for _, v in queries], dtype=np.float64)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    ids, matrix = ids[length[:, 0] > 0], (matrix / np.where(length > 0, length, 1))[length[:, 0] > 0]
    dim = matrix.shape[1]
    schema = pa.schema([("query_id", pa.int64()), (key, pa.int64()), ("score", pa.float64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(1)
            if pa.compute.any(pa.compute.not_equal(pa.compute.list_value_length(column), dim)).as_py():
                raise ValueError(f"a vector has not the {dim} elements of the queries")
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            size = np.linalg.norm(rows, axis=1)
            keys, rows = keys[size > 0], rows[size > 0] / size[size > 0, None]
            scores = np.round(rows @ matrix.T, 6)
            for q in range(len(ids)):
                old_scores, old_keys = best[q]
                floor = old_scores[-1] if len(old_scores) == k else -np.inf
                keep = scores[:, q] >= floor
                s = np.concatenate([old_scores, scores[keep, q]])
                i = np.concatenate([old_keys, keys[keep]])
                order = np.lexsort((i, -s))[:k]
                best[q] = (s[order], i[order])
        counts = [len(s) for s, _ in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(ids, counts)),
                pa.array(np.concatenate([i for _, i in best]).astype(np.int64) if best else [], pa.int64()),
                pa.array(np.concatenate([s for s, _ in best]) if best else [], pa.float64()),
            ],
            schema=schema,
        )

    found = (
        corpus.where(F.col(vector).isNotNull())
        .select(F.col(key).cast("long").alias(key), vector)
        .mapInArrow(search, f"query_id long, {key} long, score double")
    )
    return _rank(found, k, key)


def _rank(found: DataFrame, k: int, key: str) -> DataFrame:
    """The ``k`` best rows of each query, with their rank, in two rounds: of the winners of ``FAN_IN`` tasks, then
    of all rounds. So a reducer reads at most ``FAN_IN * k`` rows of a query in the first, and as many rows
    for each ``FAN_IN`` ** 2 tasks in the second."""
    parts = found.withColumn("__part", F.floor(F.spark_partition_id() / F.lit(FAN_IN)))
    first = Window.partitionBy("query_id", "__part").orderBy(F.desc("score"), F.asc(key))
    some = parts.select("*", F.row_number().over(first).alias("__r")).where(F.col("__r") <= k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    kept = [c for c in found.columns if c not in ("query_id", key, "score")]
    return some.select("query_id", F.row_number().over(order).alias("rank"), key, "score", *kept).where(F.col("rank") <= k)


def build_index(df: DataFrame, key: str, vector: str, dim: int, *payload: str) -> DataFrame:
    """The vector index as a table: unit vectors of one dimension, checked row by row."""
    checked = F.when(F.size(vector) == dim, F.col(vector)).otherwise(
        F.raise_error(F.format_string(f"vector %s has not {dim} elements", F.col(key)))
    )
    sound = df.select(key, *payload, checked.alias("__a")).where(F.exists("__a", lambda x: x != 0))
    units = Normalizer(inputCol="__v", outputCol="__u").transform(sound.withColumn("__v", array_to_vector("__a")))
    return units.select(key, *payload, vector_to_array("__u").alias(vector))


def coarse_centers(index: DataFrame, key: str, vector: str, lists: int | None = None, seed: int = 1) -> np.ndarray:
    """Centers of the coarse lists of an index, fitted on about ``FITTED_ON`` of its rows, picked by hash.

    There is a list for every ``LIST_SIZE`` rows, up to ``MOST_LISTS``, unless ``lists`` are asked for.
    """
    rows = index.count()
    lists = lists or max(1, min(MOST_LISTS, rows // LIST_SIZE))
    part = min(1.0, FITTED_ON / max(rows, 1))
    picked = F.shiftrightunsigned(F.xxhash64(key), 2) < F.lit(int(part * (1 << 62)))
    sample = index.where(picked).select(array_to_vector(F.col(vector)).alias("features"))
    if lists == 1:
        return np.zeros((1, index.select(F.size(vector)).first()[0] if rows else 1))
    return np.array(KMeans(k=lists, seed=seed, maxIter=10).fit(sample).clusterCenters())


def coded_index(index: DataFrame, centers: np.ndarray, key: str, vector: str) -> DataFrame:
    """``list, <key>, code, scale, <vector>``: the list of the nearest center and the vector in bytes.

    A byte is an element in units of ``scale``, the largest element by 127.
    """
    half = (centers**2).sum(axis=1) / 2

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            scale = np.abs(rows).max(axis=1) / 127
            codes = np.round(rows / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((rows @ centers.T - half).argmax(axis=1), pa.int32()), batch.column(0),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale, pa.float32()), batch.column(1),
                ],
                names=["list", key, "code", "scale", vector],
            )

    rows = index.select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector))
    return rows.mapInArrow(encode, f"list int, {key} long, code binary, scale float, {vector} array<double>")


def store_index(coded: DataFrame, path: str, key: str) -> DataFrame:
    """Write a coded index in the order of its lists, so that a search skips the row groups of other lists.

    Lists are cut by key range: one that holds a third of all rows is in as many files as its share.
    """
    coded.repartitionByRange("list", key).sortWithinPartitions("list", key).write.parquet(path)
    return coded.sparkSession.read.schema(coded.schema).parquet(path)


def nearest_by_code(
    stored: DataFrame,
    centers: np.ndarray,
    queries: Sequence[tuple[int, Sequence[float]]],
    k: int = 10,
    probe: float = 0.75,
    keep: int = KEEP,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Top ``k`` by cosine for each query in the ``probe`` share of lists nearest to it: ``query_id, rank, <key>, score``.

    Codes of these lists are scored first, a byte an element and a matrix product per Arrow batch, and a task
    keeps ``keep * k`` rows per query. The best ``keep * k`` of all are then scored exactly on their
    vectors, which are read from their lists only. Scores are rounded to 6 places, ties go to the smaller key.
    """
    if not 1 <= k <= MAX_RESULTS or not 0 < probe <= 1:
        raise ValueError(f"k must be 1 to {MAX_RESULTS}, probe above 0 and at most 1")
    spark, most = stored.sparkSession, k * keep
    asked = [(q, np.array(v, np.float64)) for q, v in queries]
    asked = [(q, v / np.linalg.norm(v)) for q, v in asked if np.linalg.norm(v) > 0]
    if not asked:
        return _rank(spark.createDataFrame([], f"query_id long, {key} long, score double"), k, key)
    ids, matrix = np.array([q for q, _ in asked], np.int64), np.stack([v for _, v in asked])
    half = (centers**2).sum(axis=1) / 2
    places = np.argsort(-(matrix @ centers.T - half) if len(centers) > 1 else np.zeros((len(ids), 1)), axis=1)
    probed = np.zeros((len(centers), len(ids)), bool)
    for q, lists in enumerate(places[:, : max(1, int(np.ceil(probe * len(centers))))]):
        probed[lists, q] = True
    floats = matrix.T.astype(np.float32)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.float32), np.empty(0, np.int64), np.empty(0, np.int32)) for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int8).reshape(batch.num_rows, -1)
            scores = codes.astype(np.float32) @ floats * batch.column(3).to_numpy(zero_copy_only=False)[:, None]
            scores[~probed[lists]] = -np.inf
            for q, (old, old_keys, old_lists) in enumerate(best):
                good = np.flatnonzero(scores[:, q] > (old.min() if len(old) == most else -np.inf))
                s, i, of = np.append(old, scores[good, q]), np.append(old_keys, keys[good]), np.append(old_lists, lists[good])
                if len(s) > most:
                    kept = np.argpartition(-s, most - 1)[:most]
                    s, i, of = s[kept], i[kept], of[kept]
                best[q] = s, i, of
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(ids, [len(s) for s, _, _ in best])), pa.array(np.concatenate([i for _, i, _ in best])),
                pa.array(np.concatenate([of for _, _, of in best]), pa.int32()),
                pa.array(np.concatenate([s for s, _, _ in best]).astype(np.float64)),
            ],
            names=["query_id", key, "list", "score"],
        )

    wanted = np.flatnonzero(probed.any(axis=1)).tolist()
    part = stored if len(wanted) == len(centers) else stored.where(F.col("list").isin(wanted))
    found = part.select("list", key, "code", "scale").mapInArrow(scan, f"query_id long, {key} long, list int, score double")
    # At most MAX_QUERIES * MAX_RESULTS * keep rows.
    survivors = F.broadcast(_rank(found, most, key).select("query_id", "list", key))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {int(q): v for q, v in zip(ids, matrix)}
        for batch in batches:
            of = batch.column(0).to_pylist()
            exact = [round(float(np.dot(at[q], v)), 6) for q, v in zip(of, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(exact, pa.float64())], names=["query_id", key, "score"])

    scored = part.select("list", key, vector).join(survivors, ["list", key]).select("query_id", key, vector)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    final = scored.mapInArrow(score, f"query_id long, {key} long, score double")
    return final.select("query_id", F.row_number().over(order).alias("rank"), key, "score").where(F.col("rank") <= k)


def lsh_model(
    df: DataFrame, vector: str, tables: int = 12, width: float = 1.5, seed: int = 0
) -> BucketedRandomProjectionLSHModel:
    """Random projections for unit vectors, ``HASHES`` for each of ``tables`` tables.

    ``width`` is the bucket length in standard deviations of a projection, 1/sqrt(dimension).
    """
    dim = df.select(F.size(vector)).first()[0]
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", numHashTables=tables * HASHES, bucketLength=width / dim**0.5, seed=seed
    )
    return lsh.fit(df.select(array_to_vector(F.col(vector)).alias("features")))


def hash_index(model: BucketedRandomProjectionLSHModel, index: DataFrame, key: str, vector: str) -> DataFrame:
    """Add ``buckets``, one per table. Save the result to hash a corpus once for many searches.

    A bucket of a table is where all of its projections agree, so a chance meeting is rare.
    """
    hashed = model.transform(index.select(key, vector, array_to_vector(F.col(vector)).alias("features")))
    place = F.transform("hashes", lambda h: vector_to_array(h)[0].cast("int"))
    places = hashed.select(key, vector, place.alias("__p"))
    tables = range(0, model.getNumHashTables(), HASHES)
    buckets = [F.xxhash64(*[F.col("__p")[i + j] for j in range(HASHES)]) for i in tables]
    return places.select(key, vector, F.array(*buckets).alias("buckets"))


def nearest_approximate(
    hashed: DataFrame,
    queries: DataFrame,
    model: BucketedRandomProjectionLSHModel,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Top ``k`` by cosine among the rows of :func:`hash_index` that share a bucket with the query.

    Only the queries' buckets are broadcast, and their number is checked by :func:`query_batch`,
    so a crowded bucket costs scoring but no shuffle. Every candidate is scored.
    """
    batch = hashed.sparkSession.createDataFrame(
        [(q, [float(x) for x in v]) for q, v in query_batch(queries)], "query_id long, vector array<double>"
    )
    asked = hash_index(model, batch, "query_id", "vector").withColumnRenamed("buckets", "__asked")
    asked = asked.select("*", F.posexplode("__asked").alias("table", "bucket"))
    stored = hashed.select("*", F.posexplode("buckets").alias("table", "bucket"))
    found = stored.join(F.broadcast(asked), ["table", "bucket"])
    # A row meets a query in every table they share: only the first meeting counts.
    shared = F.zip_with("buckets", "__asked", lambda a, b: a == b)
    hits = found.where(F.array_position(shared, True) - 1 == F.col("table")).select(
        "query_id", key, F.round(dot(F.col("vector"), F.col(vector)), 6).alias("score")
    )
    return _rank(hits, k, key)


def pair_similarity(pairs: DataFrame, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Dot product of each pair ``left_id, right_id``."""
    left = vectors.select(F.col(key).alias("left_id"), F.col(vector).alias("__l"))
    right = vectors.select(F.col(key).alias("right_id"), F.col(vector).alias("__r"))
    return pairs.join(left, "left_id").join(right, "right_id").select(
        "left_id", "right_id", dot(F.col("__l"), F.col("__r")).alias("similarity")
    )


def with_passages(best: DataFrame, passages: DataFrame, key: str) -> DataFrame:
    """Results of :func:`nearest` with the columns of their passages.

    There are at most ``MAX_QUERIES * MAX_RESULTS`` results, so they go to the passages, which are
    scanned once and neither shuffled nor computed on before the match.
    """
    return passages.join(F.broadcast(best), key)


def grounded_answers(best: DataFrame, passages: DataFrame, key: str, threshold: float = 0.5) -> DataFrame:
    """Answer each query by its best passage, with the passage's ids as attribution.

    ``best`` is the result of :func:`nearest` with ``k=1``. ``answerable`` compares a similarity,
    not a calibrated probability; below or at the threshold the text is null (fall back).
    """
    answerable = F.col("score") > threshold
    return with_passages(best.where("rank = 1"), passages, key).select(
        "query_id", key, "score", answerable.alias("answerable"),
        *[c for c in passages.columns if c not in (key, "text")],
        F.when(answerable, F.col("text")).alias("answer"),
    )
