import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import neardup
from tidemill.llm.common import fan_out, written
from tidemill.llm.graph import components
from tidemill.llm.neardup import (
    BITS, CHUNKS, ERRORS, MOST_DIFFERENT, VALUES, WIDTH, _across, _met, _picked, confirmed, entries, index_entries, near_copies, odd_sketch, shingle_set, signature,
    signed_documents,
)

DDL = "doc_id long, text string, node string, component string, n long"


def words_of(text):
    return (text or "").encode().lower().split()


def brute(rows):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i: i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DDL)
    return sorted(map(tuple, near_copies(docs, **more).collect()))


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("rounds", [0, 3])
def test_against_brute_force(spark, rounds):
    rng = random.Random(rounds)
    line = [f"common{i}" for i in range(30)]
    rows, doc = [], 1000
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 12, 40, 150]))] + (line if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((doc := doc - 1, " ".join(changed(rng, base, rng.randrange(max(2, len(base) // 25))))))
    crowd = [f"c{i}" for i in range(120)]
    rows += [(2000 + i, " ".join(changed(rng, crowd, rng.randrange(4)))) for i in range(120)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n\x0b"), (3003, "One two"), (3004, "one  TWO"), (3005, "one two three"), (3006, "é É")]
    rows += [rows[0], (5, rows[3][1]), (6, "b " * 5000), (7, "b b b b b b"), (8, "B " * 9)]
    assert run(spark, rows, rounds=rounds) == brute(rows)


def test_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(500 - i, " ".join(words[4 * i: 4 * i + 100])) for i in range(60)]
    got = run(spark, rows)
    assert got == brute(rows) and {r[2] for r in got} == {441}


def test_rows_without_id(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "A b c d e f"), (None, "x y"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DDL)
    got = sorted(map(tuple, near_copies(docs).collect()), key=str)
    assert got == sorted([(None, 2, 7, False), (None, 2, 7, False), (7, 2, 7, True), (None, 1, None, True), (None, 0, None, True)], key=str)


def test_empty_table(spark):
    assert run(spark, []) == []


def lanes(signatures):
    return (signatures[..., None] >> (BITS * np.arange(WIDTH))) & (2**BITS - 1)


def test_every_pair_under_the_distance_shares_an_entry():
    rng = np.random.default_rng(1)
    most = CHUNKS * (ERRORS + 1) - 1
    left = rng.integers(0, 2**BITS, (300, VALUES))
    right = left.copy()
    for row in right:
        at = rng.choice(VALUES, most, replace=False)
        row[at] ^= rng.integers(1, 2**BITS, most)
    packed = [(x.reshape(-1, CHUNKS, WIDTH) << (BITS * np.arange(WIDTH))).sum(axis=2) for x in (left, right)]
    assert (lanes(packed[0]) == left.reshape(-1, CHUNKS, WIDTH)).all()
    assert (entries(packed[0]) == entries(packed[1])).any(axis=1).all()
    assert entries(packed[0]).shape[1] == CHUNKS * WIDTH


def test_signatures_estimate_similarity():
    words = [f"w{i}" for i in range(2000)]
    a, b = shingle_set(" ".join(words)), shingle_set(" ".join(words[:1860] + [f"z{i}" for i in range(140)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((lanes(signature(a)) == lanes(signature(b))).mean() - true) < 0.2


def test_a_pair_leaves_the_last_join_once(spark):
    rng = random.Random(4)
    line = " ".join(f"l{i}" for i in range(18))
    # Alike but not linked: each a component of its own, and pairs share many entries.
    texts = [line + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(6)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = signed_documents(docs).withColumnRenamed("n_shingles", "n")
    rows = index_entries(nodes).withColumn("component", F.col("node"))
    pairs = [tuple(sorted(r)) for r in _across(rows, nodes).collect()]
    assert len(pairs) == len(set(pairs))
    found = nodes.collect()
    want = set()
    for x in found:
        for y in found:
            a, b = np.array([x["sig"]]), np.array([y["sig"]])
            if x["node"] < y["node"] and (entries(a) == entries(b)).any() and (lanes(a) != lanes(b)).sum() <= MOST_DIFFERENT:
                want.add((x["node"], y["node"]))
    assert set(pairs) == want
    assert len(want) > 100


def test_components_by_contraction(spark):
    rng = random.Random(2)
    nodes = [rng.randrange(-(2**62), 2**62) for _ in range(400)]
    links = list(zip(nodes[:200], nodes[1:200])) + [(nodes[250], n) for n in nodes[251:399]] + [(nodes[5], nodes[5])]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[n] for n in nodes[:200]} == {min(nodes[:200])} and {got[n] for n in nodes[250:399]} == {min(nodes[250:399])}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketches_rule_out_texts_that_share_a_line(spark):
    """The texts above, with sketches: no pair of them leaves the join; and linked ones do."""
    rng = random.Random(4)
    line = " ".join(f"l{i}" for i in range(18))
    texts = [line + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(6)) for _ in range(60)]
    near = [" ".join(f"y{j}" for j in range(80)) + f" z{i}" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")
    nodes = signed_documents(docs, sketched=True).withColumnRenamed("n_shingles", "n")
    rows = index_entries(nodes).withColumn("component", F.col("node"))
    by_node = {r["node"]: r["doc_id"] for r in nodes.collect()}
    pairs = {tuple(sorted(by_node[n] for n in r)) for r in _across(rows, nodes).collect()}
    assert pairs == {(60 + i, 60 + j) for j in range(12) for i in range(j)}


def test_odd_sketches_lose_no_link():
    """Sketches differ in at most as many bits as the sets in shingles, and in hardly fewer where sets are small."""
    rng = np.random.default_rng(4)
    for size in (1, 5, 40, 150, 3000):
        for share in (0.5, 0.7, 0.74, 0.75, 0.8, 1.0):
            a = rng.integers(0, 2**64 - 1, size, dtype=np.uint64)
            common = int(np.ceil(2 * size * share / (1 + share))) if size > 1 else 1
            b = np.concatenate([a[:common], rng.integers(0, 2**64 - 1, size - min(common, size), dtype=np.uint64)])
            differ = len(np.setxor1d(a, b))
            bits = int(np.bitwise_count((odd_sketch(a) ^ odd_sketch(b)).view(np.uint64)).sum())
            assert bits <= differ
            # In large sets bits meet, and the sketch rules out less.
            assert size > 150 or bits >= 0.8 * differ - 4
            if 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b)):
                assert bits * 175 <= 25 * (len(a) + len(b))


def test_a_crowd_meets_a_leader_a_chunk(spark):
    """In a crowd that shares all its entries, a node meets as many leaders as there are chunks, not entries."""
    rows = spark.createDataFrame([(slot, slot, node, node) for slot in range(VALUES) for node in range(100)], "entry long, slot int, node long, component long")
    met = _met(rows, 0)
    assert 99 <= met.count() <= CHUNKS * 100 and met.select("a").distinct().count() == 100
    assert met.where("a = b").isEmpty()


def test_sets_of_a_pair_are_intersected_once(spark):
    """At 75 % exactly a pair is linked, just below it is not; the sets are intersected in one place of the plan."""
    shingles = [" ".join(f"w{j}" for j in range(n)) for n in (79, 104, 105)]  # 75, 100 and 101 shingles
    docs = spark.createDataFrame(list(enumerate(shingles)), "doc_id long, text string")
    nodes = signed_documents(docs).withColumnRenamed("n_shingles", "n")
    node = {r["doc_id"]: r["node"] for r in nodes.collect()}
    pairs = spark.createDataFrame([(node[0], node[1]), (node[0], node[2]), (node[1], node[2])], "a long, b long")
    links = confirmed(pairs, nodes, docs)
    assert {tuple(r) for r in links.collect()} == {(node[0], node[1]), (node[1], node[2])}
    assert links._jdf.queryExecution().optimizedPlan().toString().count("array_intersect") == 1


def test_entries_are_dealt_over_all_tasks(spark, monkeypatch):
    """The few files that hold the nodes are not the tasks that make 60 entries of each."""
    parts = []

    def seen(nodes):
        parts.append(nodes.rdd.getNumPartitions())
        return index_entries(nodes)

    monkeypatch.setattr(neardup, "index_entries", seen)
    docs = spark.createDataFrame([(i, f"some words of the text with number {i}") for i in range(40)], "doc_id long, text string")
    assert near_copies(docs).count() == 40
    assert parts == [fan_out(spark)]


def test_picked_pairs_bring_their_components(spark):
    """A round needs no join to tell sizes, signatures and components of its pairs again: the driver plans each join."""
    near = [" ".join(f"y{j}" for j in range(80)) + f" z{i}" for i in range(6)]
    far = [" ".join(f"x{k}_{j}" for j in range(80)) for k in range(3)]
    docs = spark.createDataFrame(list(enumerate(near + far)), "doc_id long, text string")
    nodes = signed_documents(docs, sketched=True).withColumnRenamed("n_shingles", "n").cache()
    group = {r["node"]: r["doc_id"] // 2 for r in nodes.collect()}
    rows = written(index_entries(nodes).join(spark.createDataFrame(list(group.items()), "node long, component long"), "node"), "rows")
    picked = _picked(rows, nodes, 0)
    # Two joins with the nodes and one with the leaders.
    assert picked._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 3
    pairs = picked.collect()
    assert pairs and len({r["a"] for r in pairs}) == len(pairs)
    assert all((r["of_a"], r["of_b"]) == (group[r["a"]], group[r["b"]]) and r["of_a"] != r["of_b"] and r["of_b"] < 3 for r in pairs)


def test_names_are_written_once(spark, monkeypatch):
    """Not after every round: each table that is written costs the driver a plan, its tasks and its files."""
    labels = []
    monkeypatch.setattr(neardup, "written", lambda df, label, f=neardup.written: labels.append(label) or f(df, label))
    docs = spark.createDataFrame([(i, f"some words of the text with number {i // 2}") for i in range(20)], "doc_id long, text string")
    assert near_copies(docs).where("kept").count() == 10
    assert labels.count("names") == 1
