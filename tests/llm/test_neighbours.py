import random

import numpy as np
from pyspark.sql import functions as F

from tidemill.llm.neighbours import nearest

DDL = "vec_id long, embedding array<float>, rank int, list string, bound string"


def run(spark, rows, queries, k, **more):
    df = spark.createDataFrame([(i, v, 1, "s", "b") for i, v in rows], DDL)
    return nearest(df, df.where(F.col("vec_id").isin(queries)), k, **more).collect()


def test_recall_and_scores_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = nearest(vectors, vectors.where("vec_id % 20 = 0"), sample=256, lists=32).collect()
    rows = vectors.collect()
    ids, matrix = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    hits = 0
    for q in ids[ids % 20 == 0]:
        scores = matrix @ matrix[ids == q][0]
        scores[ids == q] = -np.inf
        found = sorted(by[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert found == sorted(found, key=lambda r: (-r["score"], r["vec_id"]))
        assert all(abs(r["score"] - scores[ids == r["vec_id"]][0]) < 1e-12 for r in found)
        hits += len({r["vec_id"] for r in found} & set(ids[np.argsort(-scores, kind="stable")[:20]]))
    assert hits / (20 * len(by)) >= 0.9


def test_unequal_lengths(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 24)) * rng.lognormal(size=(3000, 1))
    got = run(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], list(range(0, 3000, 100)), 10, sample=1000, lists=32)
    vectors = vectors.astype(np.float32).astype(float)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    hits = 0
    for q in range(0, 3000, 100):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += sum((q, int(i)) in found for i in np.argsort(-scores)[:10])
    assert hits >= 270


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, -1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]),
        (7, [0.0, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [3.0, -3.0]), (11, [0.5, 0.25]), (11, [0.5, 0.25]), (12, [0.5, 0.25]),
    ]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in run(spark, rows, list(range(13)), 3))
    assert got == [
        (1, 1, 10, 6.0), (1, 2, 11, 0.25), (1, 3, 12, 0.25), (10, 1, 1, 6.0), (10, 2, 11, 0.75), (10, 3, 12, 0.75),
        (11, 1, 10, 0.75), (11, 2, 12, 0.3125), (11, 3, 1, 0.25), (12, 1, 10, 0.75), (12, 2, 11, 0.3125), (12, 3, 1, 0.25),
    ]
    assert run(spark, [], [1], 3) == []


def test_crowd_of_one_vector(spark):
    rng = random.Random(1)
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(600)] + [(600 + i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(300)]
    got = run(spark, rows, [0, 20], 5, sample=100)
    scores = {q: [r["score"] for r in got if r["query_id"] == q] for q in (0, 20)}
    assert all(len(s) == 5 for s in scores.values())
