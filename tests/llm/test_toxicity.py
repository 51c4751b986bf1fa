import random

import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm.toxicity import fit, fit_thresholds, labelled_sample, score, scored, without_toxic

DOCS = "doc_id long, text string, severity string, toxic long, grade string"
LABELS = "doc_id long, quality int, toxic int, text string"
BAD = ["vile", "rotten", "grimlachen", "grimlung", "grimlos"]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    docs, labels, truth = [], [], {}
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        truth[i] = rng.choice([1, 2, 3, 6, 9]) if i % 4 == 0 else 0
        for _ in range(truth[i]):
            text.insert(rng.randrange(len(text)), rng.choice(BAD).capitalize())
        docs.append((i, " ".join(text) + ".", "s", 1, "g"))
        if i < n // 2:
            labels.append((i, 1, int(truth[i] > 0), "x"))
    return docs, labels, truth


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels, truth = corpus()
    return fit(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"), spark.createDataFrame(labels, LABELS)), truth, docs


def test_unlabelled_rows_are_told_apart(spark, fitted):
    model, truth, docs = fitted
    got = {r["doc_id"]: r for r in score(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"), model).collect()}
    held_out = [i for i in truth if i >= 200]
    assert all(got[i]["toxic"] == (truth[i] > 0) for i in held_out)
    means = [np.mean([got[i]["severity"] for i in held_out if truth[i] in group]) for group in ([0], [1, 2], [3, 6], [9])]
    assert means == sorted(means) and means[0] < 0.2 and means[-1] > 2
    assert {got[i]["grade"] for i in held_out} == {0, 1, 2, 3}


def test_beginnings_of_words_count(spark, fitted):
    docs = spark.createDataFrame([(1, "Ein grimlhaft wort"), (2, "ein wort")], "doc_id long, text string")
    assert [r["toxic"] for r in score(docs, fitted[0]).orderBy("doc_id").collect()] == [True, False]


def test_odd_rows_and_clashing_columns(spark, fitted):
    rows = [(None, "vile rotten", "s", 1, "g"), (1, None, None, None, None), (1, "", "s", 1, "g"), (1, "", "s", 1, "g"), (2, "ab " * 100000 + "vile", "s", 1, "g")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(((r["doc_id"], r["__x_toxic"]) for r in score(docs, fitted[0], prefix="__x_").collect()), key=str)
    assert got == [(1, False), (1, False), (1, False), (2, True), (None, True)]
    assert score(docs.limit(0).select("doc_id", "text"), fitted[0]).collect() == []


def test_rows_pass_through_whole(spark):
    docs, labels, truth = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    kept = without_toxic(frame, spark.createDataFrame(labels, LABELS))
    assert kept.schema == frame.schema
    assert sorted(map(tuple, kept.collect())) == sorted(d for d in docs if not truth[d[0]])


@pytest.mark.parametrize("labels", [[], [(0, 1, 1, "x")], [(None, 1, 1, "x"), (1, 1, None, "x"), (999, 0, 0, "x"), (0, 0, 1, "x")]])
def test_without_both_labels_nothing_is_toxic(spark, labels):
    docs = spark.createDataFrame(corpus(20)[0], DOCS)
    assert without_toxic(docs, spark.createDataFrame(labels, LABELS)).count() == 20


def test_empty_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    assert without_toxic(docs, spark.createDataFrame(corpus(20)[1], LABELS)).collect() == []


def test_fit_recovers_order_and_thresholds_rise():
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 3, (1500, 2))
    latent = 2 * x[:, 0] + x[:, 1] + rng.logistic(size=1500)
    grades = np.digitize(latent, [2, 5, 7])
    weights, limits = fit_thresholds([{0: a, 1: b} for a, b in x], grades, 2, 4, spread=100.0, steps=1500)
    assert np.allclose(weights, [2, 1], atol=0.35) and np.allclose(limits, [2, 5, 7], atol=0.8)
    assert (np.diff(limits) > 0).all()


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs, labels, truth = corpus()
    rows = [d[:2] for d in docs]
    frames = [spark.createDataFrame(r, "doc_id long, text string") for r in (rows, rows + rows[:1] * 3000 + rows[1:2] * 3000)]
    marked = spark.createDataFrame(labels, LABELS)
    once, often = (sorted(map(tuple, labelled_sample(f, marked, "doc_id", "text", "toxic").collect())) for f in frames)
    assert once == often == sorted((d, text, int(truth[d] > 0)) for d, text in rows if d < 200)
    other = spark.createDataFrame([*rows, *((0, f"other {i}") for i in range(50))], "doc_id long, text string")
    assert [r[0] for r in sorted(map(tuple, labelled_sample(other, marked, "doc_id", "text", "toxic").collect()))] == list(range(200))


def test_rows_leave_a_worker_in_small_batches(fitted):
    model, _, docs = fitted
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1200)), "text": [docs[i % 400][1] for i in range(1199)] + [None]})
    parts = list(scored(batch, model, model.lookup(), "text", ["severity", "grade", "toxic"]))
    assert [p.num_rows for p in parts] == [512, 512, 176]
    whole = pa.Table.from_batches(parts)
    assert whole.select(["doc_id", "text"]).to_pydict() == batch.to_pydict()
    severity = whole.column("severity").to_pylist()
    assert severity[400:800] == severity[:400] and whole.column("toxic").to_pylist()[-1] is False
