"""Sign projections and the similarity join, against plain Python."""

import gc
import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.operators import embedding
from tidemill.sources.shared import shared_root

DDL = "doc_id long, text string"


def bag(text):
    words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    return Counter(int(hashlib.md5(w.encode()).hexdigest()[:5], 16) >> 2 for w in words)


def brute(texts, dims=768):
    bags = [bag(t) for t in texts]
    uses = Counter(b for x in bags for b in x)
    out = []
    for x in bags:
        v = np.zeros(dims)
        for b, tf in x.items():
            bits = "".join(f"{int(hashlib.md5(f'{b}:{k}'.encode()).hexdigest(), 16):0128b}" for k in range(-(-dims // 128)))
            v += tf * math.log((len(texts) + 1) / (uses[b] + 1)) * np.array([1 if c == "1" else -1 for c in bits[:dims]])
        out.append(v / np.linalg.norm(v) if np.linalg.norm(v) else None)
    return out


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(20, 80))) for _ in range(n)]
    near = []
    for t in texts[:15]:
        changed = t.split()
        changed[3] = "Other"
        near.append(" ".join(changed))
    return texts + near + texts[:5] + [" ".join(reversed(texts[0].split()))] + ["", None, "é Ω 日本"]


@pytest.mark.parametrize("dims", [768, 100])
def test_vectors_match_python(spark, dims):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), DDL).repartition(4)
    got = {r.doc_id: r.vector for r in embedding.fit_embedder(docs, dims=dims).embed(docs, "doc_id").collect()}
    for i, want in enumerate(brute(texts, dims)):
        if want is None:
            assert got[i] is None
        else:
            assert np.allclose(got[i], want, atol=1e-9) and len(got[i]) == dims


def test_similar_texts_have_similar_vectors(spark):
    texts = ["the red fox runs in the wood at night", "the red fox runs in a wood at night", "stocks fell as rates rose again"]
    docs = spark.createDataFrame(list(enumerate(texts)), DDL)
    a, b, c = (np.array(r.vector) for r in embedding.fit_embedder(docs).embed(docs, "doc_id").orderBy("doc_id").collect())
    assert a @ b > 0.5 > 0.3 > abs(a @ c)


@pytest.mark.parametrize("least", [0.9, 0.95])
def test_similar_pairs(spark, least):
    texts = corpus(120, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), DDL)
    docs = docs.select("doc_id", "text", embedding.same_words(docs.text).alias("same"))
    vectors = embedding.fit_embedder(docs).embed(docs, "doc_id", "same")
    found = embedding.similar_pairs(vectors, least).collect()
    classes = {}
    for i, t in enumerate(texts):
        if bag(t):
            classes.setdefault(tuple(sorted(bag(t).items())), []).append(i)
    vectors = brute(texts)
    members = sorted(classes.values())
    want = {
        (a[0], b[0], len(a), len(b)) for x, a in enumerate(members) for b in members[x + 1:] if vectors[a[0]] @ vectors[b[0]] >= least
    }
    got = {(r.left_id, r.right_id, r.left_size, r.right_size) for r in found}
    assert len(found) == len(got) and got <= want and len(got) >= 0.9 * len(want) > 5
    assert max(r.left_size for r in found) > 1
    assert all(abs(r.similarity - vectors[r.left_id] @ vectors[r.right_id]) < 1e-9 for r in found)


def test_copies_are_never_paired(spark):
    docs = spark.createDataFrame([(i, "one two three four") for i in range(400)] + [(1000 + i, f"lone{i} text{i}") for i in range(50)], DDL)
    docs = docs.select("doc_id", "text", embedding.same_words(docs.text).alias("same"))
    vectors = embedding.fit_embedder(docs).embed(docs, "doc_id", "same")
    assert embedding.similar_pairs(vectors, 0.95).collect() == []
    assert embedding.similar_pairs(vectors.limit(0), 0.95).collect() == []


def test_few_vectors_are_held_at_a_time():
    numbers = [[i % 7, 100 + i] if i % 50 else [] for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": list(range(1000)), "n": pa.array(numbers, pa.list_(pa.int32())), "tf": pa.array([[1] * len(n) for n in numbers], pa.list_(pa.int64())),
    })
    made = list(embedding.project(iter([batch]), np.ones(embedding.BUCKETS), 768, ["doc_id", "vector"]))
    assert max(b.num_rows for b in made) <= embedding.ROWS and sum(b.num_rows for b in made) == 1000
    rows = [r for b in made for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows if r["vector"] is None] == list(range(0, 1000, 50))
    assert all(abs(np.linalg.norm(r["vector"]) - 1) < 1e-12 for r in rows if r["vector"])


def test_one_task_of_rows_is_dealt_over_all(spark):
    docs = spark.createDataFrame([(i, f"a b{i}") for i in range(1000)], DDL).coalesce(1)
    counts = embedding.spread(docs).groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in counts) <= 1000 / 8


def test_vectors_are_made_once_for_all_joins(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(list(enumerate(corpus())), DDL)
    docs = docs.select("doc_id", "text", embedding.same_words(docs.text).alias("same"))
    vectors = embedding.fit_embedder(docs).embed(docs, "doc_id", "same").mapInArrow(seen, "doc_id long, same string, vector array<double>")
    assert embedding.similar_pairs(vectors, 0.9).count() > 0
    assert made.value == docs.count()


def disk(spark):
    """Bytes of shuffle files and of files in the shared folder."""
    gc.collect()
    spark._jvm.System.gc()
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shuffled = sum(blocks.apply(i).length() for i in range(blocks.length()))
    return shuffled + sum(f.stat().st_size for f in Path(shared_root(spark).removeprefix("file:")).rglob("*") if f.is_file())


def cluster(n, length=60, seed=5):
    """Texts of which any two are alike, and none the same."""
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(length)]
    return [" ".join([*words * 3, *rng.sample(words, 3)]) for _ in range(n)] + [f"other{i} lone{i}" for i in range(n)]


def test_vectors_are_not_written_for_each_pair(spark):
    docs = spark.createDataFrame(list(enumerate(cluster(250))), DDL)
    docs = docs.select("doc_id", "text", embedding.same_words(docs.text).alias("same"))
    vectors = embedding.fit_embedder(docs).embed(docs, "doc_id", "same")
    before = disk(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as of tables too large for it
    try:
        found = embedding.similar_pairs(vectors, 0.9)
        pairs = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(pairs) > 20_000
    # A vector has 6 KB: these are three times all vectors, and a twentieth of a vector a pair.
    assert disk(spark) - before < 500 * 6200 * 3


def test_pairs_of_bags_need_no_stored_vectors(spark):
    texts = corpus(400, 9) + corpus(120, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), DDL).select("doc_id", embedding.bag_arrays(F.col("text")).alias("bag"))
    docs = embedding.written(docs.select("*", embedding.same_words(docs.bag, bagged=True).alias("same")), "bags")
    embedder = embedding.fit_embedder(docs, "bag")
    vectors = embedder.embed(docs, "doc_id", "same", text="bag")
    before = disk(spark)
    found = embedding.similar_pairs(vectors, 0.9, source=embedding.packed(docs.select("doc_id", "same", "bag")), made=embedder.of_bags(spark)).collect()
    assert disk(spark) - before < len(texts) * 6200 / 2
    stored = embedding.similar_pairs(vectors, 0.9).collect()
    assert len(found) > 10 and sorted((r.left_id, r.right_id, r.left_size, r.right_size) for r in found) == sorted(
        (r.left_id, r.right_id, r.left_size, r.right_size) for r in stored
    )
    want = brute(texts)
    assert all(abs(r.similarity - want[r.left_id] @ want[r.right_id]) < 1e-9 for r in found)


def test_a_cluster_is_cut_into_tiles(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(cluster(60))), DDL)
    docs = docs.select("doc_id", "text", embedding.same_words(docs.text).alias("same"))
    vectors = embedding.fit_embedder(docs).embed(docs, "doc_id", "same")
    whole = sorted(embedding.similar_pairs(vectors, 0.9).collect())
    monkeypatch.setattr(embedding, "TILE", 8)
    monkeypatch.setattr(embedding, "BANDS_AT_ONCE", 7)
    assert len(whole) > 1000 and [tuple(r)[:2] for r in sorted(embedding.similar_pairs(vectors, 0.9).collect())] == [tuple(r)[:2] for r in whole]
    pairs = spark.createDataFrame([(i, j) for i in range(60) for j in range(i + 1, 60)], "left_id long, right_id long")
    tiles = embedding._tiled(pairs)
    ids = tiles.select("tile", F.explode(F.array("left_id", "right_id")).alias("id")).distinct().groupBy("tile").count().collect()
    assert tiles.count() == pairs.count() and len(ids) > 8 and max(r["count"] for r in ids) < 60


def test_pairs_of_vectors_half_zero_are_kept():
    """Texts of two words of about one weight: half of the elements are small, and their signs tell nothing."""
    rng = np.random.default_rng(3)
    a, b = rng.choice([-1.0, 1.0], (2, 400, 768))
    for first, second in ((5 * a + 5 * b, 5 * a + 6 * b), (5 * a + 5 * b, 6 * a + 5 * b)):
        x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (first, second))
        assert ((x * y).sum(axis=1) > 0.95).all()
        differ = ((x >= 0) != (y >= 0)).sum(axis=1)
        assert differ.max() > 150 and (differ <= embedding.most_different(x, 0.95)).all()
    x = rng.normal(size=(400, 768))
    y = 0.95 * x + (1 - 0.95**2) ** 0.5 * rng.normal(size=x.shape)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    told = embedding.most_different(x, 0.95)
    assert (((x >= 0) != (y >= 0)).sum(axis=1) <= told).all() and told.max() < 240
