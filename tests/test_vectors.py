import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import vector_math as vm
from tidemill.operators import learning, relational as rel, sampling, vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def planted(seed=0, per_class=40, dim=16, classes=4, far=5):
    """Four tight classes and ``far`` points far from the class they belong to."""
    rng = np.random.default_rng(seed)
    centers = np.eye(dim)[:classes] * 4
    rows = []
    for c in range(classes):
        for v in centers[c] + rng.normal(0, 0.05, (per_class, dim)):
            rows.append((len(rows), [float(x) for x in v], c))
    for _ in range(far):
        rows.append((len(rows), [float(x) for x in -centers[0] * 3 + rng.normal(0, 0.05, dim)], len(rows) % classes))
    return rows


@pytest.fixture(scope="module")
def rows():
    return planted()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, VECTORS).repartition(5, "vec_id").cache()


def test_only_the_far_points_are_outliers(table):
    found = vectors.outliers(vectors.centroid_distances(table, "label", "embedding"), 5.0)
    assert sorted(r.vec_id for r in found.collect()) == list(range(160, 165))


def test_distances_match_numpy(table, rows):
    got = {r.vec_id: r.distance for r in vectors.centroid_distances(table, "label", "embedding").collect()}
    data = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    labels = np.array([r[2] for r in rows])
    for c in range(4):
        center = data[labels == c].mean(axis=0)
        for i in np.flatnonzero(labels == c):
            assert got[i] == pytest.approx(np.linalg.norm(data[i] - center), abs=1e-9)


def test_sweep_never_rises(table):
    radii = vectors.radius_range(30, 76, 2)
    assert radii[0] == 0.3 and radii[-1] == 0.74 and len(radii) == 23
    distances = vectors.centroid_distances(table, "label", "embedding")
    counts = [r.n_outliers for r in vectors.outlier_sweep(distances, radii).orderBy("radius").collect()]
    assert counts == sorted(counts, reverse=True)
    assert counts[0] == distances.where("distance > 0.3").count()


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        v = np.array(v) / np.linalg.norm(v)
        scored = [(-round(float(np.dot(np.array(x, np.float32) / np.linalg.norm(np.array(x, np.float32)), v)), 6), i)
                  for i, x, _ in rows if any(x)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def test_nearest_is_exact(spark, rows):
    queries = [(7, [1.0] * 16), (9, rows[3][1]), (11, [0.0] * 16)]
    extra = rows + [(900 + i, rows[3][1], 0) for i in range(30)] + [(999, [0.0] * 16, 0)]  # copies tie, zero never matches
    corpus = spark.createDataFrame(extra, VECTORS).repartition(7, "vec_id")
    got = sorted(map(tuple, vectors.nearest(corpus, queries, k=20).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in brute(extra, queries[:2], 20)]
    assert all(math.isclose(g[3], w[3], abs_tol=2e-6) for g, w in zip(got, brute(extra, queries[:2], 20)))
    assert vectors.nearest(corpus, [], k=3).count() == 0
    assert vectors.nearest(corpus.where("vec_id < 0"), queries, k=3).count() == 0


def test_nearest_rejects_wrong_lengths_and_too_many(spark, table):
    bad = table.select("vec_id", "embedding").unionByName(
        spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"))
    with pytest.raises(Exception, match="has not the 16 elements"):
        vectors.nearest(bad, [(0, [1.0] * 16)]).collect()
    with pytest.raises(Exception, match="has not 16 elements"):
        vectors.build_index(bad, "vec_id", "embedding", 16).collect()
    with pytest.raises(ValueError):
        vectors.nearest(table, [(0, [1.0] * 16)], k=101)
    many = table.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    with pytest.raises(ValueError, match="several requests"):
        vectors.query_batch(many, limit=10)


def test_only_active_chunks_are_found(spark, rows):
    from tidemill.operators.filters import active

    corpus = spark.createDataFrame([(i, v, "ACTIVE" if i else "FAILED") for i, v, _ in rows],
                                   "vec_id long, embedding array<float>, state string")
    best = vectors.nearest(corpus.where(active()), [(0, rows[0][1])], k=1).first()
    assert best.vec_id != 0


def test_approximate_search_finds_most_of_the_exact(spark):
    """600 vectors in 40 groups: neighbours are near, the rest is not."""
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 1, (40, 32))
    rows = [(i, [float(x) for x in centers[i % 40] + rng.normal(0, 0.3, 32)], 0) for i in range(600)]
    corpus = vectors.build_index(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", 32)
    queries = corpus.where("vec_id < 20").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    model = vectors.lsh_model(corpus, "embedding")
    hashed = vectors.hash_index(model, corpus, "vec_id", "embedding")
    found = vectors.nearest_approximate(hashed, queries, model, k=10).collect()
    exact = {(r.query_id, r.vec_id): r.score for r in vectors.nearest(corpus, vectors.query_batch(queries), k=10).collect()}
    hits = {(r.query_id, r.vec_id): r.score for r in found}
    assert len(hits) == len(found) <= 200
    assert len(hits.keys() & exact.keys()) / len(exact) >= 0.95
    assert all(abs(hits[k] - exact[k]) < 2e-6 for k in hits.keys() & exact.keys())

    buckets = {r.vec_id: set(enumerate(r.buckets)) for r in hashed.collect()}
    met = sum(bool(buckets[q] & b) for q in range(20) for b in buckets.values())
    assert met / (20 * 600) < 0.5  # most of the corpus is never scored


def test_index_vectors_have_length_one(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "id long, v array<float>")
    assert [(r.id, [round(x, 6) for x in r.v]) for r in vectors.build_index(df, "id", "v", 2).collect()] == [(1, [0.6, 0.8])]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0, 4.0], [0.0, 0.0, 0.0])], "a array<float>, z array<float>")
    a, z = F.col("a"), F.col("z")
    r = df.select(vm.dot(a, a), vm.euclidean(a, z), vm.cosine(a, a), vm.cosine(a, z), vm.argmax(a)).first()
    assert r[0] == 41 and r[1] == pytest.approx(math.sqrt(41)) and r[2] == pytest.approx(1) and r[3] is None and r[4] == 1


def test_grounded_answers(spark):
    best = spark.createDataFrame([(1, 1, 10, 0.8), (2, 1, 11, 0.5), (2, 2, 10, 0.1)], "query_id long, rank int, chunk long, score double")
    passages = spark.createDataFrame([(10, "docs/a", "yes"), (11, "docs/b", "maybe")], "chunk long, document string, text string")
    got = {r.query_id: r for r in vectors.grounded_answers(best, passages, "chunk").collect()}
    assert (got[1].answerable, got[1].answer, got[1].document) == (True, "yes", "docs/a")
    assert (got[2].answerable, got[2].answer, got[2].document) == (False, None, "docs/b")


def test_clusters_recover_classes(table):
    clean = table.where("vec_id < 160")
    assigned = learning.cluster(clean, "embedding", k=4, seed=1)
    majority = rel.mode_per_group(assigned, "label", "cluster")
    named = assigned.join(learning.clusters_to_classes(majority, "label", "cluster"), "cluster", "left")
    scores = rel.accuracy_by_class(named, "label", "predicted").collect()
    assert len(scores) == 4 and sum(r.accuracy for r in scores) >= 3


def test_shared_and_unclaimed_clusters(spark):
    majority = spark.createDataFrame([(3, 0), (1, 0), (2, 5)], "label int, cluster int")
    got = {r.cluster: r.predicted for r in learning.clusters_to_classes(majority, "label", "cluster").collect()}
    assert got == {0: 1, 5: 2}


def test_mode_tie_is_the_smallest(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", None), ("b", 3)], "g string, v int")
    assert {r.g: r.v for r in rel.mode_per_group(df, "g", "v").collect()} == {"a": 1, "b": 3}


def test_classifiers_learn_planted_classes(table):
    from pyspark.ml.functions import array_to_vector

    ready = table.where("vec_id < 160").select("vec_id", "label", array_to_vector("embedding").alias("features"))
    split = sampling.train_test_split(ready, "label", "vec_id", 25, 10)
    train, test = split.where("part = 'train'"), split.where("part = 'test'")
    for model in (
        learning.train_logistic(train, "features", "label"),
        learning.train_perceptron(train, "features", "label", dims=16, classes=4, max_iter=60),
    ):
        scores = learning.evaluate(model.transform(test), "label")
        assert scores["accuracy"] >= 0.9 and scores["logLoss"] < 1
        curve = learning.learning_curve(model)
        assert curve[-1] < curve[0]


def test_projection_separates_classes(table):
    points = learning.project(table.where("label < 2 AND vec_id < 160"), "embedding")
    means = {r.label: r.m for r in points.groupBy("label").agg(F.avg("pc1").alias("m")).collect()}
    assert abs(means[0] - means[1]) > 4


def test_labels_are_coded_in_order(spark):
    df = spark.createDataFrame([("sci.space",), ("sci.crypt",), ("sci.med",), ("sci.med",)], "name string")
    assert {r.name: r.encoded for r in learning.encode_labels(df, "name").collect()} == {"sci.crypt": 0, "sci.med": 1, "sci.space": 2}


def test_own_embedder_runs_in_batches_with_retry(spark):
    def load():
        calls = {"n": 0}

        def encode(texts):
            calls["n"] += 1
            if calls["n"] == 1:
                raise RuntimeError("busy")
            return [[float(len(t))] for t in texts]

        return encode

    embed = learning.embed_with(load)
    docs = spark.createDataFrame([("a",), ("bbb",)], "text string").coalesce(1)
    assert [r.v for r in docs.select(embed(F.col("text")).alias("v")).collect()] == [[1.0], [3.0]]


def test_text_features_have_length_one(spark):
    docs = spark.createDataFrame([(1, "red fox"), (2, "blue whale sings")], "doc_id long, text string")
    got = learning.embed_text(learning.text_features(docs, dims=64), docs, "doc_id").collect()
    assert all(np.linalg.norm(r.features.toArray()) == pytest.approx(1) for r in got)


def test_samples(spark):
    df = spark.createDataFrame([(i, "big" if i % 10 else "small") for i in range(500)], "id long, label string")
    sample = sampling.stratified_sample(df, "label", "id", 60, seed=3)
    assert {r.label: r["count"] for r in sample.groupBy("label").count().collect()} == {"big": 60, "small": 50}
    assert sample.exceptAll(sampling.stratified_sample(df.repartition(3), "label", "id", 60, seed=3)).count() == 0
    other = sampling.stratified_sample(df, "label", "id", 60, seed=4)
    assert sample.exceptAll(other).count() > 0
    split = sampling.train_test_split(df, "label", "id", 100, 25)
    sizes = {(r.label, r.part): r["count"] for r in split.groupBy("label", "part").count().collect()}
    assert sizes["big", "train"] == 100 and sizes["big", "test"] == 25
    assert split.select("id").distinct().count() == split.count()
    assert 0 < sampling.approximate_sample(df, "label", {"big": 0.1}, 1).count() < 120


def test_confusion_matrix_fills_zeros(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", None)], "y string, p string")
    got = {r.y: (r.predicted_a, r.predicted_b, r.predicted_c) for r in rel.confusion_matrix(df, "y", "p", ["a", "b", "c"]).collect()}
    assert got == {"a": (1, 1, 0), "b": (0, 0, 0)}
    other = {r.y: r.predicted_other for r in rel.confusion_matrix(df, "y", "p", ["a"]).collect()}
    assert other == {"a": 1, "b": 1}
    scores = {r.y: r.accuracy for r in rel.accuracy_by_class(df, "y", "p").collect()}
    assert scores == {"a": 0.5, "b": 0.0}


def clustered(n, groups=40, dim=32, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (groups, dim))
    return [(i, [float(x) for x in centers[i % groups] + rng.normal(0, 0.3, dim)], 0) for i in range(n)]


@pytest.mark.parametrize("lists", [1, 8, 30])
def test_search_by_code_finds_the_exact_neighbours(spark, root, lists):
    rows = clustered(1500) + [(5000 + i, [0.5] * 32, 0) for i in range(40)]  # copies tie
    index = vectors.build_index(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", 32).repartition(6)
    queries = [(i, rows[i][1]) for i in range(25)] + [(77, [0.5] * 32), (78, [0.0] * 32)]
    centers = vectors.coarse_centers(index, "vec_id", "embedding", lists)
    stored = vectors.store_index(vectors.coded_index(index, centers, "vec_id", "embedding"), root, "vec_id")
    assert stored.count() == 1540 and len(centers) == lists
    exact = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vectors.nearest(index, queries, k=10).collect()}
    whole = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vectors.nearest_by_code(stored, centers, queries, 10, 1.0).collect()}
    pairs = [(exact[q, r], whole[q, r]) for q, r in exact if q != 77]
    assert len(whole) == 260 and sum(a[0] == b[0] for a, b in pairs) >= 0.99 * len(pairs)
    assert all(abs(a[1] - b[1]) < 2e-6 for a, b in pairs if a[0] == b[0])
    some = {(r.query_id, r.vec_id) for r in vectors.nearest_by_code(stored, centers, queries, 10, 0.4).collect()}
    found = {(q, v) for (q, _), (v, _) in exact.items() if q != 77}
    assert len(some & found) >= 0.9 * len(found)


def test_index_lists_are_read_alone(spark, root):
    index = vectors.build_index(spark.createDataFrame(clustered(800), VECTORS), "vec_id", "embedding", 32)
    centers = vectors.coarse_centers(index, "vec_id", "embedding", 8)
    stored = vectors.store_index(vectors.coded_index(index, centers, "vec_id", "embedding"), root, "vec_id")
    found = vectors.nearest_by_code(stored, centers, [(0, clustered(1)[0][1])], 5, 0.25)
    text = found._jdf.queryExecution().toString()
    # Codes and vectors are read apart, codes from the probed lists.
    assert "ReadSchema: struct<list:int,vec_id:bigint,code:binary,scale:float>" in text and "PushedFilters: [In(list, [" in text
    assert "ReadSchema: struct<list:int,vec_id:bigint,embedding:array<double>>" in text


def test_empty_index(spark, root):
    index = vectors.build_index(spark.createDataFrame([], VECTORS), "vec_id", "embedding", 32)
    centers = vectors.coarse_centers(index, "vec_id", "embedding")
    stored = vectors.store_index(vectors.coded_index(index, centers, "vec_id", "embedding"), root, "vec_id")
    assert vectors.nearest_by_code(stored, centers, [(0, [1.0] * 32)], 5).collect() == []


def test_winners_are_merged_in_two_rounds(spark):
    rows = [(q, i, float((i * 37) % 1000)) for q in range(3) for i in range(1000)]
    found = spark.createDataFrame(rows, "query_id long, vec_id long, score double").repartition(7)
    got = vectors._rank(found, 20, "vec_id")
    want = {q: [(r + 1, i) for r, (s, i) in enumerate(sorted((-s, i) for p, i, s in rows if p == q)[:20])] for q in range(3)}
    assert {q: sorted((r.rank, r.vec_id) for r in got.collect() if r.query_id == q) for q in range(3)} == want
    # A reducer of the first round has the winners of a part of the tasks.
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning(query_id") == 2 and "__part" in plan


def test_millions_of_labels_are_coded_side_by_side(spark):
    n = 3_000_000
    df = spark.range(n).select(F.format_string("%010d", (F.col("id") * 7919) % n).alias("name"))
    coded = learning.encode_labels(df, "name")
    assert coded.where(F.col("name").cast("int") != F.col("encoded")).count() == 0 and coded.count() == n
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == plan.count("windowspecdefinition(__block") == 1


def test_large_samples_are_cut_by_a_hash_threshold(spark):
    n = 400_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 50 == 1, "small").when(F.col("id") % 50 > 1, "mid").alias("label"))
    sizes = {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    sample = sampling.stratified_sample(df, "label", "id", 60_000, seed=5)
    assert {r.label: r["count"] for r in sample.groupBy("label").count().collect()} == {k: min(v, 60_000) for k, v in sizes.items()}
    # They are the rows with the smallest hashes.
    hashed = df.withColumn("h", sampling.hash_order("id", 5)).where("label = 'big'")
    edge = sample.where("label = 'big'").withColumn("h", sampling.hash_order("id", 5)).agg(F.max("h")).first()[0]
    assert hashed.where(F.col("h") <= edge).count() == 60_000
    # A small sample is the beginning of a large one.
    assert sampling.stratified_sample(df, "label", "id", 900, seed=5).exceptAll(sample).count() == 0
    plan = sample._jdf.queryExecution().toString()
    assert "Window [" in plan and all("__bin" in line for line in plan.splitlines() if "Window [" in line)


def test_large_split(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 2).alias("label"))
    split = sampling.train_test_split(df, "label", "id", 5000, 1200)
    sizes = {(r.label, r.part): r["count"] for r in split.groupBy("label", "part").count().collect()}
    assert sizes == {(k, p): c for k in (0, 1) for p, c in (("train", 5000), ("test", 1200))}
    assert split.columns == ["id", "label", "part"]


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    layers = [rng.normal(0, 0.5, (6, 6)), rng.normal(0, 0.1, 6), rng.normal(0, 0.5, (6, 3)), rng.normal(0, 0.1, 3)]
    rows, codes = rng.normal(0, 1, (9, 6)), rng.integers(0, 3, 9)

    def loss():
        return learning._quality(learning._softmax(learning._outputs(layers, rows)[1]), codes)[0]

    slopes, _ = learning.gradients(layers, rows, codes)
    for layer, slope in zip(layers, slopes):
        for place in np.ndindex(*layer.shape):
            old = layer[place]
            layer[place] = old + 1e-6
            up = loss()
            layer[place] = old - 1e-6
            down = loss()
            layer[place] = old
            assert abs((up - down) / 2e-6 - slope[place]) < 1e-6


def test_network_learns_planted_classes_and_stops(spark):
    known = spark.createDataFrame(planted(seed=6, per_class=250, far=0), VECTORS).repartition(5)
    split = sampling.with_part(known, "vec_id", 0.6)
    train, held_out = split.where("part = 'train'"), split.where("part = 'test'")
    network = learning.train_network(train, "embedding", "label", held_out)
    assert network.classes == (0, 1, 2, 3) and network.epochs <= 20
    scored = learning.score_rows(held_out, network, "embedding", "label", "vec_id")
    whole = {r.bin: r for r in learning.evaluate_rows(scored, "label").collect()}
    assert whole[None].accuracy >= 0.95 and whole[None].n == held_out.count() == sum(r.n for b, r in whole.items() if b is not None)
    curve = network.curve
    assert [c[0] for c in curve] == list(range(1, network.epochs + 1)) and curve[-1][1] < curve[0][1]
    # It ends three epochs after the best training accuracy, or after twenty.
    best = max(range(len(curve)), key=lambda i: (curve[i][2], -i))
    assert network.epochs == 20 or network.epochs == best + 4
    again = learning.train_network(train.repartition(3), "embedding", "label", held_out)
    assert again.curve == curve
    with pytest.raises(ValueError, match="no rows"):
        learning.train_network(train.limit(0), "embedding", "label")


def test_evaluation_matches_sql_over_the_scored_rows(spark, table, tmp_path):
    import duckdb

    network = learning.train_network(table.where("vec_id < 100"), "embedding", "label", epochs=3)
    scored = learning.score_rows(table, network, "embedding", "label", "vec_id")  # labels 3 were not seen
    scored.toPandas().to_parquet(tmp_path / "scored.parquet")
    sql = f"""SELECT bin, count(*), -avg(ln(greatest(chance, 1e-7))), avg((predicted = label)::INTEGER), avg(confidence)
              FROM (SELECT *, least(floor(confidence * 10), 9)::INTEGER AS bin FROM '{tmp_path}/scored.parquet') GROUP BY ROLLUP (bin)"""
    want = sorted(duckdb.sql(sql).fetchall(), key=str)
    got = sorted(map(tuple, learning.evaluate_rows(scored, "label").collect()), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(g[2:] == pytest.approx(w[2:]) for g, w in zip(got, want))
    rows = learning.curve_rows(spark, network).collect()
    assert [r.epoch for r in rows] == [1, 2, 3] and rows[0].held_out_loss is None and rows[2].loss < rows[0].loss
