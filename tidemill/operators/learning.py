"""Feature vectors, projection, clustering and classification with MLlib."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import NON_WORD
from tidemill.operators.skew import positions

# Executors need not have this package: what tasks run travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def text_features(docs: DataFrame, text: str = "text", dims: int = 256) -> PipelineModel:
    """TF-IDF of hashed words, scaled to length 1; ``transform`` adds ``features``."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=NON_WORD),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=dims),
        IDF(inputCol="__tf", outputCol="__tfidf"),
        Normalizer(inputCol="__tfidf", outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(docs)


def embed_text(model: PipelineModel, docs: DataFrame, *keep: str) -> DataFrame:
    return model.transform(docs).select(*keep, "features")


def embed_with(load: Callable[[], Callable[[list[str]], list[list[float]]]], attempts: int = 3) -> Callable[[Column], Column]:
    """A column function for a model of your own: ``load`` runs once per task, its result embeds
    one Arrow batch of texts at a time and is called again when it fails."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for batch in batches:
            for attempt in range(1, attempts + 1):
                try:
                    yield pd.Series(encode(batch.tolist()))
                    break
                except Exception:
                    if attempt == attempts:
                        raise

    return embed


def project(df: DataFrame, vector: str, dims: int = 2) -> DataFrame:
    """Principal components ``pc1, pc2, …``, a linear map to view vectors in the plane.

    A component's sign is free: here its largest weight, the first of equals, is positive.
    """
    ready = df.withColumn("__v", array_to_vector(F.col(vector)))
    model = PCA(k=dims, inputCol="__v", outputCol="__p").fit(ready)
    weights = model.pc.toArray()
    signs = [1.0 if column[np.abs(column).argmax()] > 0 else -1.0 for column in weights.T]
    point = vector_to_array("__p")
    return model.transform(ready).select(*df.columns, *[(point[i] * signs[i]).alias(f"pc{i + 1}") for i in range(dims)])


def cluster(df: DataFrame, vector: str, k: int = 4, seed: int = 1, steps: int = 20, tol: float = 1e-4) -> DataFrame:
    """k-means; adds ``cluster``."""
    ready = df.withColumn("__v", array_to_vector(F.col(vector)))
    model = KMeans(k=k, seed=seed, maxIter=steps, tol=tol, featuresCol="__v", predictionCol="cluster").fit(ready)
    return model.transform(ready).select(*df.columns, "cluster")


def clusters_to_classes(majority: DataFrame, label: str, cluster: str) -> DataFrame:
    """``cluster -> predicted class`` from each class's majority cluster.

    A cluster claimed by several classes goes to the lowest; one nobody claims has no row.
    """
    return majority.groupBy(cluster).agg(F.min(label).alias("predicted"))


def encode_labels(df: DataFrame, label: str, out: str = "encoded") -> DataFrame:
    """0-based codes of the labels present, in ascending order.

    Only the distinct labels are numbered, in ranges side by side, however many they are; rows get their
    code by a join.
    """
    codes = positions(df.where(F.col(label).isNotNull()).select(label).distinct(), [], label, out=out)
    return df.join(codes.withColumn(out, F.col(out).cast("int")), label)


def train_logistic(train: DataFrame, features: str, label: str, max_iter: int = 50):
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter).fit(train)


def train_perceptron(train: DataFrame, features: str, label: str, dims: int, classes: int, max_iter: int = 20, seed: int = 0):
    """One hidden layer as wide as the input; ``max_iter`` passes, 32 rows per block."""
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=[dims, dims, classes], maxIter=max_iter, blockSize=32, seed=seed
    ).fit(train)


# Rows that a network is trained on: they come to the driver, and more are an error.
MOST_TRAINED = 100_000
BINS = 10


@dataclass(frozen=True)
class Network:
    """dense(d, ReLU) and dense(k, sigmoid), its classes, and a row per epoch that was run."""

    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    classes: tuple
    curve: tuple[tuple[int, float, float, float | None, float | None], ...]

    @property
    def epochs(self) -> int:
        return len(self.curve)


def _outputs(layers, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(rows @ w1 + b1, 0)
    return hidden, 1 / (1 + np.exp(-(hidden @ w2 + b2)))


def _softmax(outputs: np.ndarray) -> np.ndarray:
    powers = np.exp(outputs - outputs.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _quality(chances: np.ndarray, codes: np.ndarray) -> tuple[float, float]:
    """Log loss and accuracy."""
    return float(-np.log(chances[np.arange(len(codes)), codes]).mean()), float((chances.argmax(axis=1) == codes).mean())


def gradients(layers, rows: np.ndarray, codes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The loss's gradient by each layer, and the class probabilities, of one batch.

    The loss is the cross-entropy of the softmax of the sigmoid outputs.
    """
    hidden, out = _outputs(layers, rows)
    chances = _softmax(out)
    error = chances.copy()
    error[np.arange(len(codes)), codes] -= 1
    error = error / len(codes) * out * (1 - out)
    below = (error @ layers[2].T) * (hidden > 0)
    return [rows.T @ below, below.sum(axis=0), hidden.T @ error, error.sum(axis=0)], chances


def train_network(
    train: DataFrame, vector: str, label: str, held_out: DataFrame | None = None, epochs: int = 20, batch: int = 32,
    rate: float = 1e-3, patience: int = 3, seed: int = 0,
) -> Network:
    """Adam in batches of ``batch``, up to ``epochs`` passes, ended after ``patience`` of them without a better training accuracy.

    ``train`` is a sample of at most ``MOST_TRAINED`` rows, which are ordered by content first, so that the same rows
    give the same network. Sizes come from the data. The curve has, per epoch, loss and accuracy over
    its batches as they were trained, and of ``held_out``, a sample alike.
    """

    def local(df: DataFrame) -> tuple[np.ndarray, list]:
        rows = df.select(F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("l")).limit(MOST_TRAINED + 1).collect()
        if len(rows) > MOST_TRAINED:
            raise ValueError(f"at most {MOST_TRAINED} rows to train on; sample them first")
        rows.sort(key=lambda r: (r["l"], r["v"]))
        return np.array([r["v"] for r in rows], np.float64), [r["l"] for r in rows]

    rows, labels = local(train)
    if not len(rows):
        raise ValueError("no rows to train on")
    classes = tuple(sorted(set(labels)))
    code = {c: i for i, c in enumerate(classes)}
    codes = np.array([code[c] for c in labels])
    other = None
    if held_out is not None:
        kept, names = local(held_out)
        known = [i for i, n in enumerate(names) if n in code]
        if known:
            other = kept[known], np.array([code[names[i]] for i in known])
    rng = np.random.default_rng(seed)
    dims = rows.shape[1]
    spread = lambda a, b: rng.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b))
    layers = [spread(dims, dims), np.zeros(dims), spread(dims, len(classes)), np.zeros(len(classes))]
    first, second = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers]
    curve, best, since, step = [], -1.0, 0, 0
    for epoch in range(1, epochs + 1):
        loss, right = 0.0, 0
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at: at + batch]
            slopes, chances = gradients(layers, rows[some], codes[some])
            loss -= float(np.log(chances[np.arange(len(some)), codes[some]]).sum())
            right += int((chances.argmax(axis=1) == codes[some]).sum())
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                layers[i] = layers[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-7)
        seen = _quality(_softmax(_outputs(layers, other[0])[1]), other[1]) if other else (None, None)
        curve.append((epoch, loss / len(rows), right / len(rows), *seen))
        since = 0 if right / len(rows) > best else since + 1
        best = max(best, right / len(rows))
        if since >= patience:
            break
    return Network(tuple(layers), classes, tuple(curve))


def score_rows(df: DataFrame, network: Network, vector: str, label: str, *keep: str) -> DataFrame:
    """``<keep>, <label>, predicted, confidence, chance`` of all rows: the likeliest class, its probability, and that of the label.

    A label that the network has not seen has chance 0. No shuffle; the network is sent to every task.
    """
    sent = df.sparkSession.sparkContext.broadcast((network.layers, network.classes))
    kind = df.schema[label].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers, classes = sent.value
        code = {c: i for i, c in enumerate(classes)}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            chances = _softmax(_outputs(layers, rows)[1])
            best, own = chances.argmax(axis=1), [code.get(x) for x in batch.column(batch.num_columns - 2).to_pylist()]
            columns = [
                *batch.columns[:-1], pa.array([classes[b] for b in best], batch.schema.field(batch.num_columns - 2).type),
                pa.array(chances.max(axis=1)), pa.array([0.0 if c is None else chances[i, c] for i, c in enumerate(own)], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, label, "predicted", "confidence", "chance"])

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    rows = df.select(*keep, label, F.col(vector).cast("array<double>").alias("__v"))
    return rows.mapInArrow(score, f"{kinds}`{label}` {kind}, predicted {kind}, confidence double, chance double")


def evaluate_rows(scored: DataFrame, label: str, bins: int = BINS) -> DataFrame:
    """``bin, n, loss, accuracy, confidence`` in one aggregate: of all rows (``bin`` null), and of those in each
    of ``bins`` equal ranges of confidence, by which a network is calibrated where accuracy meets confidence."""
    number = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    rows = scored.select(number.alias("bin"), (F.col("predicted") == F.col(label)).cast("double").alias("right"), "confidence", "chance")
    # A chance of 0 would be an endless loss.
    loss = -F.avg(F.log(F.greatest(F.col("chance"), F.lit(1e-7))))
    return rows.rollup("bin").agg(
        F.count("*").alias("n"), loss.alias("loss"), F.avg("right").alias("accuracy"), F.avg("confidence").alias("confidence")
    )


def curve_rows(spark: SparkSession, network: Network) -> DataFrame:
    """The learning curve as a table: a row per epoch that was run."""
    return spark.createDataFrame(list(network.curve), "epoch int, loss double, accuracy double, held_out_loss double, held_out_accuracy double")


def evaluate(predictions: DataFrame, label: str) -> dict[str, float]:
    """Accuracy and log loss; two scalars on the driver."""
    return {
        name: MulticlassClassificationEvaluator(labelCol=label, metricName=name).evaluate(predictions)
        for name in ("accuracy", "logLoss")
    }


def learning_curve(model) -> list[float]:
    """The objective after each iteration."""
    summary = model.summary() if callable(model.summary) else model.summary
    return list(summary.objectiveHistory)
