"""Queries against all rows, in blocks.

Vectors go to cells of a grid: one block of queries and one group of candidates each. A cell is read
as a stream, queries first, so a task holds one block of queries, their best results so far, and one
batch of candidates. Only the best ``k`` of each query and cell leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import below

QUERY_BLOCK = 4096
END = 2**63 - 1
# Totals of numbers up to 64e300 are under this.
SHIFT, DIGITS = 10**620, 621


def usable(df: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """``id, vector, dim`` of the rows that take part: an id, and a vector of finite components that
    is not empty, nor zero unless ``zero``."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(key).isNotNull() & (F.size(vector) > 0) & finite)
    if not zero:
        rows = rows.where(F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.size(vector).alias("dim"))


class Best:
    """The best ``k`` candidates of one query: largest score first, ties to the smaller id. With
    ``once``, rows of one id count as one, at their best score."""

    __slots__ = ("k", "scores", "ids", "floor", "once")

    def __init__(self, k: int, kind, floor, once: bool = False):
        self.k, self.floor, self.once = k, floor, once
        self.scores, self.ids = np.empty(0, kind), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor
        if not keep.any():
            return
        scores, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (-int(scores[i]), ids[i])))
        else:
            order = np.lexsort((ids, -scores))
        if self.once:
            order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
        order = order[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = self.scores[-1]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def shown(scores: list, kind) -> tuple[np.ndarray, list[str]]:
    """Scores as ``kind``, and, for whole ones at or beyond the ends of 64 bits, a text that sorts as they do."""
    if kind is not np.int64:
        return np.concatenate(scores).astype(kind), []
    exact = [int(s) for part in scores for s in part]
    held = np.array([max(-END - 1, min(END, s)) for s in exact], np.int64)
    return held, ["" if -END - 1 < s < END else f"{s + SHIFT:0{DIGITS}d}" for s in exact]


def mark(vector: np.ndarray) -> int:
    """Tells queries of one id and different vectors apart."""
    return xxhash.xxh3_64_intdigest(vector.astype(np.float64).tobytes()) - 2**63


def search_cells(
    rows: DataFrame, cell: list[str], more: list[str], k: int, search: Callable, kind, score_type: str, once: bool = False,
) -> DataFrame:
    """Run ``search`` in every cell and give ``query_id, mark, id, score`` of each query's best; whole scores
    also have ``beyond``, by which those that 64 bits do not hold are ranked.

    ``rows`` has the columns of ``cell`` (the first is the dimension), ``is_row`` (0 for queries),
    ``id, vector``, and the columns ``more`` that queries bring. ``search(queries, batch, best)`` gets
    the cell's queries (``id, vector, *more`` as arrays), a batch (``id, vector``) and a list of
    :class:`Best`, and is called once for each batch of candidates.
    """
    names = [*cell, "is_row", "id", "vector", *more]
    schema = pa.schema([
        ("query_id", pa.int64()), ("mark", pa.int64()), ("id", pa.int64()),
        *([("score", pa.int64()), ("beyond", pa.string())] if score_type == "long" else [("score", pa.float64())]),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_cell, pending, queries, best = None, [], None, []

        def results() -> Iterator[pa.RecordBatch]:
            found = [b for b in best if len(b.ids)]
            if found:
                counts = [len(b.ids) for b in best]
                marks = np.array([mark(v) for v in queries[1]], np.int64)
                scores, beyond = shown([b.scores for b in best], kind)
                columns = [np.repeat(queries[0], counts), np.repeat(marks, counts), np.concatenate([b.ids for b in best]), scores]
                if score_type == "long":
                    columns.append(beyond)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(cell) + 1)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                here, is_row = tuple(keys[:-1, a]), keys[-1, a]
                if here != open_cell:
                    yield from results()
                    open_cell, pending, queries, best = here, [], None, []
                part = batch.slice(a, b - a)
                ids = part.column(len(cell) + 1).to_numpy(zero_copy_only=False)
                vectors = matrix(part.column(len(cell) + 2), int(here[0]))
                if not is_row:
                    extra = [part.column(len(cell) + 3 + i).to_numpy(zero_copy_only=False) for i in range(len(more))]
                    pending.append((ids, vectors, *extra))
                    continue
                if pending:
                    queries = tuple(np.concatenate(parts) for parts in zip(*pending))
                    best = [Best(k, kind, -np.inf, once) for _ in queries[0]]
                    pending = []
                if queries is not None:
                    search(queries, (ids, vectors), best)
        yield from results()

    ordered = rows.select(*names).repartition(*cell).sortWithinPartitions(*cell, "is_row")
    return ordered.mapInArrow(run, f"query_id long, mark long, id long, score {score_type}" + ", beyond string" * (score_type == "long"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query over all cells: ``query_id, rank, vec_id, score``."""
    beyond = [F.desc("beyond")] if "beyond" in found.columns else []
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), *beyond, F.asc("id"))
    rows = found.select("query_id", F.row_number().over(order).alias("rank"), F.col("id").alias("vec_id"), "score")
    return rows.where(F.col("rank") <= k)


def spread(count: int, key: Column) -> Column:
    """One of ``count`` numbers, by hash."""
    return below(key, count) if count > 1 else F.lit(0)
