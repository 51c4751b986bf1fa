"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

Features are words, and word beginnings of four and five letters. A sample of labelled rows, at most
``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``, chooses at most ``FEATURES`` of them, those that toxic texts have most
significantly more often, and fits one weight per feature and one threshold per grade:
``P(grade > j) = sigmoid(w . x - threshold_j)``, with the same weights for all thresholds. Grade 0 is
clean; toxic rows of the sample are graded 1 to ``GRADES - 1`` by the number of their words that
carry a telling feature, in parts as equal as ties allow. Weights are at least 0, so a word never makes a text less severe. Every document is scored whole: its expected severity is the
sum of these probabilities, its grade the number of them that are at least one half, and it is toxic from
grade 1.

Defined cases: a null or empty text has no features; labels that are null, or of documents that are
not there, do not count, and a document labelled both ways counts as toxic, and
one text of an id that repeats is in the sample; without labels of both
kinds every severity is 0 and nothing is toxic; null ids are kept and scored; repeated rows get
the same score each; empty tables give no rows; other columns are ignored, or kept where rows are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import remembered, share, shared, table, written
from tidemill.llm.pieces import Recent

SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 16000
FEATURES = 4096
GRADES = 4
LEAST_G = 20.0
TELLING = 20.0
BEGINNINGS = (4, 5)
WORDS = re.compile(r"[^\W\d_]+")


def features_of_word(word: str) -> list[str]:
    return [word[:32], *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def word_counts(text: str | None) -> Counter:
    return Counter(WORDS.findall((text or "").lower()))


@dataclass(frozen=True)
class Model:
    """Weights of features, rising thresholds, and whether a feature is telling (used to grade the sample)."""

    names: tuple[str, ...]
    telling: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def vector(self, counts: Counter, found) -> dict[int, float]:
        """Sparse features: 1 + ln of the number of words that have each."""
        sums: dict[int, int] = {}
        for word, n in counts.items():
            for i in found[word]:
                sums[i] = sums.get(i, 0) + n
        return {i: 1 + float(np.log(n)) for i, n in sums.items()}

    def lookup(self) -> Recent:
        """The features of a word that the model has."""
        index = {name: i for i, name in enumerate(self.names)}
        return Recent(lambda word: tuple(index[f] for f in features_of_word(word) if f in index))

    def severity(self, x: dict[int, float]) -> np.ndarray:
        """P(grade > j) for each threshold."""
        total = sum(self.weights[i] * v for i, v in x.items())
        return 1 / (1 + np.exp(np.clip(self.thresholds - total, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``doc_id, text, toxic`` of a bounded number of rows of each label, chosen by a hash of the id.

    Clean rows are more, so that a word of a few toxic rows by chance is seen in clean ones too.
    """
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).cast("long").alias("doc_id"))
    marked = marked.agg(F.max(F.col(label).cast("int")).alias("toxic"))
    there = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id")).distinct()
    marked = marked.join(there, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = marked.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC)
    chosen = chosen.unionByName(marked.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN ids, by the limits above, and one row of each, however often it is there.
    found = texts.join(F.broadcast(written(chosen, "labelled")), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return found.groupBy("doc_id", "toxic").agg(one).select("doc_id", "one.text", "toxic")


def choose_features(sample: DataFrame, most: int = FEATURES) -> list[tuple[str, bool]]:
    """The features that toxic rows have most significantly more often, and whether they are telling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted({f for w in word_counts(text) for f in features_of_word(w)})
                yield pa.RecordBatch.from_pydict({"feature": pa.array(found, pa.string()), "toxic": pa.array([toxic] * len(found), pa.int32())})

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    bad, good = float(sizes[1]), float(sizes[0])
    seen = sample.select("toxic", "text").mapInArrow(run, "feature string, toxic int").groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    )
    share_ = (F.col("a") + F.col("b")) / (bad + good)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    score = 2 * (
        part(F.col("a"), bad * share_) + part(F.col("b"), good * share_)
        + part(bad - F.col("a"), bad * (1 - share_)) + part(good - F.col("b"), good * (1 - share_))
    )
    odds = ((F.col("a") + 0.5) / (bad - F.col("a") + 0.5)) / ((F.col("b") + 0.5) / (good - F.col("b") + 0.5))
    best = seen.where(F.col("a") * good > F.col("b") * bad).select("feature", score.alias("score"), (odds >= TELLING).alias("telling"))
    rows = best.where(F.col("score") >= LEAST_G).orderBy(F.desc("score"), "feature").limit(most).collect()
    return [(r["feature"], r["telling"]) for r in rows]


def fit_thresholds(
    rows: list[dict[int, float]], grades: np.ndarray, n_features: int, n_grades: int = GRADES, spread: float = 3.0, steps: int = 400,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of the cumulative-link model, by gradient steps on the likelihood,
    with a normal prior of deviation ``spread`` on the weights."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([i for r in rows for i in r], dtype=np.int64)
    value = np.array([v for r in rows for v in r.values()], dtype=np.float64)
    return fit_sparse(row, column, value, grades, n_features, n_grades, spread, steps)


def fit_sparse(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int = GRADES,
    spread: float = 3.0, steps: int = 400,
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`fit_thresholds` of rows given as places and values."""
    n_rows = len(grades)
    weight = 1 / max(1, n_rows)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    # Parameters: weights, the first threshold, and logarithms of the gaps to the next ones.
    p = np.concatenate([np.zeros(n_features), [0.5], np.zeros(n_grades - 2)])
    first, second = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(n_rows)
    for step in range(1, steps + 1):
        gaps = np.exp(p[n_features + 1:])
        limits = np.concatenate([[p[n_features]], p[n_features] + np.cumsum(gaps)])
        z = np.bincount(row, p[column] * value, n_rows)
        over = sigmoid(z[:, None] - limits)
        padded = np.hstack([np.ones((n_rows, 1)), over, np.zeros((n_rows, 1))])
        slope = padded * (1 - padded)
        chance = np.maximum(padded[at, grades] - padded[at, grades + 1], 1e-12)
        # d log P / dz, and with respect to the limits on both sides of the grade.
        up, down = slope[at, grades] / chance * weight, slope[at, grades + 1] / chance * weight
        dz = up - down
        dlimit = np.zeros(n_grades + 1)
        np.add.at(dlimit, grades, -up)
        np.add.at(dlimit, grades + 1, down)
        dlimit = dlimit[1:n_grades]
        dgap = np.cumsum(dlimit[::-1])[::-1][1:] * gaps
        gradient = np.concatenate([
            np.bincount(column, dz[row] * value, n_features) - weight * p[:n_features] / spread**2,
            [dlimit.sum()], dgap,
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        p = p + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        np.maximum(p[:n_features], 0, out=p[:n_features])
    return p[:n_features], np.concatenate([[p[n_features]], p[n_features] + np.cumsum(np.exp(p[n_features + 1:]))])


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", grades: int = GRADES,
) -> Model:
    """A model of the labelled rows. The driver fits it on a bounded number of sparse rows."""
    sample = written(labelled_sample(docs, labels, key, text, label), "sample")
    chosen = choose_features(sample)
    names, telling = tuple(n for n, _ in chosen), np.array([t for _, t in chosen], dtype=bool)
    draft = Model(names, telling, np.zeros(len(names)), np.full(grades - 1, 1e9))
    if not names:
        return draft

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = draft.lookup()
        for batch in batches:
            for doc, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts = word_counts(text)
                x = draft.vector(counts, found)
                marked = sum(n for w, n in counts.items() if any(telling[i] for i in found[w]))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": [doc], "toxic": pa.array([toxic], pa.int32()), "marked": [marked],
                    "i": pa.array([list(x)], pa.list_(pa.int32())), "v": pa.array([list(x.values())], pa.list_(pa.float64())),
                })

    ddl = "doc_id long, toxic int, marked long, i array<int>, v array<double>"
    # As Arrow columns: rows as Python objects would be many times as large on the driver.
    rows = sample.select("doc_id", "toxic", "text").mapInArrow(run, ddl).orderBy("doc_id", "marked").toArrow().combine_chunks()
    toxic, marked = (rows.column(c).to_numpy() for c in ("toxic", "marked"))
    held = rows.column("i").combine_chunks()
    sizes = pc.list_value_length(held).to_numpy(zero_copy_only=False)
    column = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    value = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    cuts = np.quantile(marked[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    graded = np.where(toxic == 1, 1 + np.searchsorted(cuts, marked, side="left"), 0)
    weights, thresholds = fit_sparse(np.repeat(np.arange(len(sizes)), sizes), column, value, graded, len(names), grades)
    return Model(names, telling, weights, thresholds)


def scored(batch: pa.RecordBatch, model: Model, found: Recent, text: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` with their severity, grade and verdict, 512 at a time: a whole batch with its texts would
    be held once more by the worker and by its executor."""
    at = batch.schema.get_field_index(text)
    for start in range(0, batch.num_rows, 512):
        part = batch.slice(start, 512)
        chances = [model.severity(model.vector(word_counts(content), found)) for content in part.column(at).to_pylist()]
        table_ = np.array(chances).reshape(len(chances), len(model.thresholds))
        grade = (table_ >= 0.5).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(table_.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(grade >= 1)],
            names=[*part.schema.names, *names],
        )


def score(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``severity, grade, toxic`` (named after ``prefix``). No shuffle."""
    sent = share(docs.sparkSession, model)
    names = [prefix + n for n in ("severity", "grade", "toxic")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        found = remembered("toxic words", own.names, own.lookup)
        for batch in batches:
            yield from scored(batch, own, found, text, names)

    kinds = (T.DoubleType(), T.IntegerType(), T.BooleanType())
    added = [T.StructField(n, kind) for n, kind in zip(names, kinds)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, as they are."""
    prefix = "__toxicity_"
    return score(docs, fit(docs, labels), prefix=prefix).where(~F.col(f"{prefix}toxic")).select(*docs.columns)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
