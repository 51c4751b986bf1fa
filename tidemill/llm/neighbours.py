"""Approximate nearest vectors: lists around centroids, scanned in column blocks that give up early.

The largest inner product is the smallest distance once rows get one more component that makes them
all as long as the longest, and queries are given that length. A random rotation spreads the
length of a difference evenly over the columns, so a partial distance over the first columns
estimates the whole. After each block of columns a candidate is dropped if its estimate is so far above
the distance of the query's k-th neighbour that this would hardly happen by chance; what survives
all blocks is scored exactly, in double precision, on the original vectors.

Centroids are fitted on a sample of at most ``SAMPLE`` rows, chosen by a hash; every row is in the
index. The sample also starts each query: its k-th neighbour in the sample bounds the result, and the
sample's neighbours are candidates. A query probes the share ``PROBES`` of the lists, nearest
first. The given vectors have next to no structure (see the README for recall by share), so it is high.

Defined cases: rows whose id is null, or whose vector is null, empty, zero, or has a component that is
null or not finite take no part; a query meets only candidates of its dimension, of which a table may
have at most 16; rows that repeat an id are found once, at their best score, and not by their own id; a
repeated id with the same vector is one query; fewer candidates than k give all of them;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import share, shared, table, written
from tidemill.llm.grid import Best, mark, matrix, ranked, search_cells, usable

K = 20
LISTS = 64
PROBES = 0.75
SAMPLE = 4096
CONFIDENCE = 2.1
BLOCK = 16
CELL_ROWS = 1 << 17
MOST_DIMENSIONS = 16
QUERY_STEP = 512


@dataclass(frozen=True)
class Index:
    """What tasks need to place rows and queries: a few hundred kB, by the limits above."""

    longest: float
    rotation: np.ndarray
    centroids: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray

    def placed(self, rows: np.ndarray) -> np.ndarray:
        """Rows as rotated vectors of one length."""
        rest = np.sqrt(np.maximum(self.longest**2 - (rows**2).sum(axis=1), 0))
        return np.hstack([rows, rest[:, None]]) @ self.rotation

    def asked(self, queries: np.ndarray) -> np.ndarray:
        scale = self.longest / np.sqrt((queries**2).sum(axis=1, keepdims=True))
        return np.hstack([queries * scale, np.zeros((len(queries), 1))]) @ self.rotation

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, less what is the same for all."""
        return (self.centroids**2).sum(axis=1) - 2 * points @ self.centroids.T

    def sample_best(self, own: int, query: np.ndarray, k: int) -> Best:
        best = Best(k, np.float64, -np.inf, once=True)
        others = self.ids != own
        best.add(dots(query, self.vectors[others]), self.ids[others])
        return best


def dots(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", rows, query)


def centroids_of(points: np.ndarray, lists: int, seed: int = 0, rounds: int = 12) -> np.ndarray:
    centres = points[np.random.default_rng(seed).choice(len(points), min(lists, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def fit_index(rows: DataFrame, dim: int, lists: int = LISTS, sample: int = SAMPLE, seed: int = 0) -> Index:
    """Fit on a bounded sample of ``rows`` (``id, vector``)."""
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    longest = rows.agg(F.max(length)).first()[0]
    chosen = rows.orderBy(F.xxhash64("id", "vector"), "id").select("id", "vector").limit(sample).collect()
    ids, vectors = np.array([r["id"] for r in chosen], np.int64), np.array([r["vector"] for r in chosen])
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim + 1, dim + 1)))
    draft = Index(longest, rotation, np.empty((0, dim + 1)), ids, vectors)
    return Index(longest, rotation, centroids_of(draft.placed(vectors), lists, seed), ids, vectors)


def index_rows(rows: DataFrame, index: Index) -> DataFrame:
    """``dim, list, id, vector`` of every row."""
    sent = share(rows.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        for batch in batches:
            if batch.num_rows:
                points = own.placed(matrix(batch.column(2), len(own.rotation) - 1))
                nearest = np.argmin(own.distances(points), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(nearest.astype(np.int32)), batch.column(1), batch.column(2)], names=["dim", "list", "id", "vector"]
                )

    return rows.select("dim", "id", "vector").mapInArrow(run, "dim int, list int, id long, vector array<double>")


def route(queries: DataFrame, index: Index, k: int, probes: int) -> DataFrame:
    """``dim, list, id, vector, bound``: every query, once for each list that it probes."""
    sent = share(queries.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column(2), len(own.rotation) - 1)
                near = np.argsort(own.distances(own.asked(vectors)), axis=1, kind="stable")[:, :probes]
                ids = batch.column(1).to_pylist()
                bounds = [own.sample_best(i, v, k).floor for i, v in zip(ids, vectors)]
                times = pa.array(np.repeat(np.arange(len(ids)), near.shape[1]))
                repeated = batch.take(times)
                yield pa.RecordBatch.from_arrays(
                    [repeated.column(0), pa.array(near.ravel().astype(np.int32)), repeated.column(1), repeated.column(2), pa.array(np.array(bounds)).take(times)],
                    names=["dim", "list", "id", "vector", "bound"],
                )

    return queries.select("dim", "id", "vector").mapInArrow(run, "dim int, list int, id long, vector array<double>, bound double")


def sample_hits(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """The best of the sample for every query, in the form of :func:`search_cells`."""
    sent = share(queries.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column(1), len(own.rotation) - 1)
                for i, vector in zip(batch.column(0).to_pylist(), vectors):
                    best = own.sample_best(i, vector, k)
                    yield pa.RecordBatch.from_pydict({
                        "query_id": np.full(len(best.ids), i), "mark": np.full(len(best.ids), mark(vector)), "id": best.ids, "score": best.scores,
                    })

    return queries.select("id", "vector").mapInArrow(run, "query_id long, mark long, id long, score double")


def scanner(sent, confidence: float = CONFIDENCE, block: int = BLOCK):
    """The search of one cell, for :func:`search_cells`."""

    def scan(queries: tuple, batch: tuple, best: list[Best]) -> None:
        index = shared(sent)
        ids, rows = batch
        points = index.placed(rows).astype(np.float32)
        dim = points.shape[1]
        edges = [*range(0, dim, block), dim]
        for start in range(0, len(queries[0]), QUERY_STEP):
            own, vectors, bounds = (q[start: start + QUERY_STEP] for q in queries)
            tops = best[start: start + QUERY_STEP]
            for top, bound in zip(tops, bounds):
                top.floor = max(top.floor, bound)
            asked = index.asked(vectors)
            scale = index.longest / np.sqrt((vectors**2).sum(axis=1))
            # The squared distance of the k-th neighbour so far.
            reach = 2 * index.longest**2 - 2 * np.array([t.floor for t in tops]) * scale
            reach = reach.astype(np.float32) * np.float32(1 + 1e-5) + np.float32(1e-6 * index.longest**2)
            asked = asked.astype(np.float32)
            partial = np.zeros((len(own), len(ids)), np.float32)
            alive = own[:, None] != ids[None, :]
            for a, b in zip(edges, edges[1:]):
                q, x = asked[:, a:b], points[:, a:b]
                if 3 * np.count_nonzero(alive) > alive.size:
                    partial += (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * q @ x.T
                else:
                    i, j = np.nonzero(alive)
                    partial[i, j] += ((q[i] - x[j]) ** 2).sum(axis=1)
                slack = (1 + confidence / b**0.5) ** 2 * b / dim if b < dim else 1.0
                alive &= partial <= (reach * np.float32(slack))[:, None]
            for i in np.flatnonzero(alive.any(axis=1)):
                hits = np.flatnonzero(alive[i])
                tops[i].add(dots(vectors[i], rows[hits]), ids[hits])

    return scan


def _search(rows: DataFrame, asked: DataFrame, dim: int, k: int, lists: int, probes: float, sample: int) -> DataFrame:
    spark = rows.sparkSession
    index = fit_index(rows, dim, lists, sample)
    placed = written(index_rows(rows, index), "index")
    sizes = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    parts = F.array(*[F.lit(max(1, -(-sizes.get(i, 0) // CELL_ROWS))) for i in range(len(index.centroids))])[F.col("list")]
    routed = route(asked, index, k, max(1, round(probes * len(index.centroids))))
    left = routed.select("dim", "list", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("is_row"), "id", "vector", "bound")
    right = placed.select(
        "dim", "list", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), F.lit(1).alias("is_row"), "id", "vector",
        F.lit(0.0).alias("bound"),
    )
    scan = scanner(share(spark, index))
    found = search_cells(left.unionByName(right), ["dim", "list", "part"], ["bound"], k, scan, np.float64, "double", once=True)
    return found.unionByName(sample_hits(asked, index, k))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding",
    lists: int = LISTS, probes: float = PROBES, sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest inner products that were found."""
    rows = usable(vectors, key, vector, zero=False)
    asked = usable(queries, key, vector, zero=False).distinct()
    dims = [r["dim"] for r in rows.select("dim").distinct().limit(MOST_DIMENSIONS + 1).collect()]
    if len(dims) > MOST_DIMENSIONS:
        raise ValueError(f"vectors of more than {MOST_DIMENSIONS} dimensions")
    found = [_search(rows.where(F.col("dim") == d), asked.where(F.col("dim") == d), d, k, lists, probes, sample) for d in dims]
    if not found:
        found = [vectors.sparkSession.createDataFrame([], "query_id long, mark long, id long, score double")]
    once = reduce(DataFrame.unionByName, found).groupBy("query_id", "mark", "id").agg(F.max("score").alias("score"))
    return ranked(once, k)


def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
