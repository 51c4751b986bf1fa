"""Exact top-k by Fagin's threshold algorithm.

Vectors become whole numbers, floor(64 x). In every cell of the grid each batch of candidates is sorted once
per dimension. A query reads the lists of its dimensions in parallel, from the top where its
component is positive and from the bottom where it is negative, scores whatever it meets, and stops
when the best total that unread entries could reach is below its k-th score. Since equal scores go
to smaller ids, an equal bound does not stop it.

Defined cases: rows whose id is null, or whose vector is null, empty or has a component that is null
or not finite, or beyond ``LARGEST`` in size, take no part; totals are exact, whatever their size, in floats,
64-bit numbers or Python's integers, and ranked so; a score beyond 64 bits is shown as the largest or
smallest such number; a query meets only candidates of its dimension; rows that repeat an id
are candidates each, and no candidates of each other; a repeated id with the same vector is one query;
fewer candidates than k give all of them; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import fan_out, table
from tidemill.llm.grid import QUERY_BLOCK, Best, ranked, search_cells, spread, usable

K = 20
# 64 times a component must be a number.
LARGEST = 1e300
FIRST_DEPTH = 64


def whole(x: Column) -> Column:
    """floor(64 x); numbers from 2**53 on have no fraction."""
    scaled = x * 64
    return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)


def in_range(rows: DataFrame) -> DataFrame:
    return rows.where(~F.exists("vector", lambda x: F.abs(x) > LARGEST)).select("id", "dim", F.transform("vector", whole).alias("vector"))


def numbers(wanted: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the smallest kind of number that holds every total and bound exactly."""
    most = int(np.abs(wanted).max()) * int(np.abs(vectors).max()) * vectors.shape[1]
    if most < 2**53:
        return wanted, vectors
    if most < 2**63:
        return wanted.astype(np.int64), vectors.astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    return as_int(wanted), as_int(vectors)


class Lists:
    """The candidates of one batch in their sorted lists.

    Rows ``0..d-1`` of ``order`` list candidates by falling, rows ``d..2d-1`` by rising component.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        falling = np.argsort(-vectors, axis=0, kind="stable").T.astype(np.int32)
        self.order = np.concatenate([falling, falling[:, ::-1]])
        self.size, self.dim = vectors.shape
        self.depths = [0]
        step = FIRST_DEPTH
        while self.depths[-1] < self.size:
            self.depths.append(min(step, self.size))
            step *= 2

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and depth, the most that an entry not yet read can reach."""
        last = np.maximum(np.array(self.depths) - 1, 0)
        dims = np.arange(self.dim)
        high = self.vectors[self.order[: self.dim, last], dims[:, None]]
        low = self.vectors[self.order[self.dim:, last], dims[:, None]]
        return np.maximum(queries, 0) @ high + np.minimum(queries, 0) @ low


def threshold_search(queries: tuple, batch: tuple, best: list[Best]) -> None:
    """Bring ``best`` up to date with a batch of candidates."""
    query_ids, wanted = queries
    ids, vectors = batch
    lists = Lists(vectors)
    wanted, all_vectors = numbers(wanted, vectors)
    lists.vectors = all_vectors
    bounds = lists.bounds(wanted)
    dims = np.arange(lists.dim)
    for i, own in enumerate(query_ids):
        top, query, bound = best[i], wanted[i], bounds[i]
        if len(top.ids) == top.k and bound[0] < top.floor:
            continue
        used = np.flatnonzero(query)
        rows = np.where(query[used] > 0, dims[used], dims[used] + lists.dim)
        scored = ids == own
        for level in range(1, len(lists.depths)):
            met = np.zeros(lists.size, bool)
            if len(rows):
                met[lists.order[rows, lists.depths[level - 1]: lists.depths[level]]] = True
            else:
                met[:] = True
            met &= ~scored
            scored |= met
            n = np.count_nonzero(met)
            if n:
                # Copying most rows out costs more than scoring a few of them again.
                scores = (all_vectors @ query)[met] if 2 * n > lists.size else all_vectors[met] @ query
                top.add(scores, ids[met])
            if scored.all() or len(top.ids) == top.k and bound[level] < top.floor:
                break


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding", group_rows: int = 1 << 20,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest whole-number inner products.

    Candidates are dealt to groups of at most ``group_rows`` and at least 4096 rows or so, in between
    by the number of shuffle tasks; queries to blocks of some 4096. The work is queries times
    candidates, and so is the traffic, divided by the size of a block.
    """
    spark = vectors.sparkSession
    rows = in_range(usable(vectors, key, vector, zero=True))
    asked = in_range(usable(queries, key, vector, zero=True)).distinct()
    n, n_asked = vectors.count(), queries.count()
    groups = max(-(-n // group_rows), min(fan_out(spark), -(-n // 4096)), 1)
    blocks = max(1, -(-n_asked // QUERY_BLOCK))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = asked.select("dim", spread(blocks, F.col("id")).alias("block"), every(groups).alias("group"), F.lit(0).alias("is_row"), "id", "vector")
    salt = F.xxhash64("id", "vector")
    right = rows.select("dim", every(blocks).alias("block"), spread(groups, salt).alias("group"), F.lit(1).alias("is_row"), "id", "vector")
    found = search_cells(left.unionByName(right), ["dim", "block", "group"], [], k, threshold_search, np.int64, "long")
    return ranked(found, k)


def op6_threshold_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
