import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemill.operators import chunking


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def python_pieces(tokens, size, overlap):
    step, out, at = size - overlap, [], 0
    while tokens and (not out or at + overlap < len(tokens)):
        out.append(tokens[at : at + size])
        at += step
    return out


@pytest.mark.parametrize("size,overlap", [(1000, 0), (10, 0), (7, 3), (2, 1), (1, 0)])
def test_pieces(spark, size, overlap):
    rng = random.Random(size)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in (0, 1, 2, 9, 10, 11, 63, 700)]
    got = {}
    for r in chunking.split_tokens(docs_of(spark, *texts), size, overlap).collect():
        got[r.doc_id, r.piece] = r.text.split()
        assert r.n_tokens == len(got[r.doc_id, r.piece]) <= size
    for i, text in enumerate(texts):
        want = python_pieces(text.split(), size, overlap)
        assert [got.get((i, p)) for p in range(len(want))] == want
        assert (i, len(want)) not in got


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        chunking.split_tokens(docs_of(spark, "a"), 5, 5)


def python_pack(sizes, budget):
    out, group, used = [], -1, 0
    for s in sizes:
        if group >= 0 and used + s <= budget:
            used += s
        else:
            group, used = group + 1, s
        out.append(group)
    return out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 60), max_size=12), min_size=1, max_size=20), st.integers(1, 50))
def test_pack(spark, lists, budget):
    df = spark.createDataFrame(list(enumerate(lists)), "i long, sizes array<int>")
    got = {r.i: r.g for r in df.select("i", chunking.pack(F.col("sizes"), budget).alias("g")).collect()}
    assert [got[i] for i in range(len(lists))] == [python_pack(s, budget) for s in lists]


def test_piece_sizes_match_pieces(spark):
    docs = docs_of(spark, "", "a", " ".join("abcdefg"), " ".join("abcdef"))
    got = [r.s for r in docs.select("doc_id", chunking.piece_sizes(F.col("text"), 3).alias("s")).orderBy("doc_id").collect()]
    assert got == [[], [1], [3, 3, 1], [3, 3]]


def test_themes_find_the_word_that_sets_a_text_apart(spark):
    common = "the of and " * 30
    docs = docs_of(spark, common + "volcano volcano lava", common + "orbit orbit rocket", common)
    topics = {r.doc_id: r.primary_topic for r in chunking.primary_topics(docs).collect()}
    assert topics[0] == "volcano" and topics[1] == "orbit"
    tags = {r.doc_id: r for r in chunking.tag_documents(docs_of(spark, "good happy day", "hate war fight", "so", "")).collect()}
    assert [tags[i].sentiment for i in range(4)] == ["happy", "sad", "neutral", "neutral"]
    assert [tags[i].aggressiveness for i in range(4)] == [1, 5, 1, 1]


def test_refine_keeps_what_it_has(spark):
    docs = docs_of(spark, "ant ant ant bee bee cat " + "dog dog dog ant ant elk", "zebra")
    themes = chunking.piece_themes(docs, size=6, n=2)
    steps = [r.summary for r in chunking.refine_summary(themes).where("doc_id = 0").orderBy("piece").collect()]
    assert steps == [["ant", "bee"], ["ant", "bee", "dog"]]
    merged = {r.word: (r.rank, r.n_pieces) for r in chunking.theme_summary(themes).where("doc_id = 0").collect()}
    assert merged["ant"] == (1, 2)


def test_language(spark):
    samples = {
        "english": "the cat sat on the mat with a dog", "french": "le chat est sur la table avec une souris",
        "german": "der Hund und die Katze sind nicht auf dem Tisch", "italian": "il gatto non è con la sua amica di Roma",
        "spanish": "el gato y los perros no se ven por las calles",
    }
    got = chunking.with_language(docs_of(spark, *samples.values())).orderBy("doc_id").collect()
    assert [r.language for r in got] == list(samples)


def test_words_are_counted_in_their_row(spark):
    rng = random.Random(7)
    lists = [[], ["a"], ["b", "a", "b"], [rng.choice("abcdefé日") for _ in range(3000)], [f"w{i}" for i in range(500)]]
    df = spark.createDataFrame(list(enumerate(lists)), "i long, ws array<string>")
    got = {r.i: [(c.word, c.tf) for c in r.c] for r in df.select("i", chunking.counted(F.col("ws")).alias("c")).collect()}
    for i, ws in enumerate(lists):
        assert got[i] == [(w, ws.count(w)) for w in sorted(set(ws), key=lambda w: w.encode())]


def test_no_exchange_carries_texts_or_their_words(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (chunking.piece_themes(docs), chunking.tag_with_topic(docs.select("doc_id", "text"))):
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
        for at, line in enumerate(plan):
            if "Exchange hashpartitioning(doc_id" in line:
                # Only the best words of a task's pieces are sent on.
                assert "WindowGroupLimit" in plan[at + 1] and "Partial" in plan[at + 1]
        assert not any("text#" in line for line in plan if "Exchange" in line)


def test_tags_are_checked(spark):
    docs = spark.createDataFrame([(1, "good happy day volcano volcano", "u1"), (2, "", "u2"), (3, None, "u3"), (4, "hate war volcano", None)],
                                 "doc_id long, text string, url string")
    got = {r.doc_id: r for r in chunking.tag_with_topic(docs, "doc_id", "text", "url").collect()}
    assert len(got) == 4 and (got[1].sentiment, got[1].valid, got[1].errors, got[1].url) == ("happy", True, [], "u1")
    assert not got[2].valid and got[2].errors == ["primary_topic: missing"] and got[2].sentiment == "neutral"
    assert not got[3].valid and got[3].url == "u3" and got[4].aggressiveness == 5


def test_refine_adds_in_order(spark):
    rng = random.Random(3)
    docs = docs_of(spark, *[" ".join(f"w{rng.randrange(40)}" for _ in range(n)) for n in (0, 3, 50, 400)])
    themes = chunking.piece_themes(docs, size=10, n=3).cache()
    added = sorted(map(tuple, chunking.refine_additions(themes).collect()), key=lambda r: (r[0], r[2]))
    assert len(added) == themes.select("doc_id", "word").distinct().count()
    best = {}
    for r in sorted(themes.collect(), key=lambda r: (r.doc_id, r.piece, -r.score, r.word)):
        best.setdefault((r.doc_id, r.word), r.piece)
    want, place = [], {}
    for (doc, word), piece in best.items():
        want.append((doc, piece, place.setdefault(doc, 0), word))
        place[doc] += 1
    assert added == sorted(want, key=lambda r: (r[0], r[2]))
    for step in chunking.refine_summary(themes).collect():
        assert step.summary == [w for d, p, _, w in added if d == step.doc_id and p <= step.piece]


def test_page_text(spark):
    html = "<html><head><style>a{b}</style><SCRIPT src='x'>var a = '<p>';</script ></head><!-- no --><body>Hello <b>big</b> world</body></html>"
    page = spark.createDataFrame([(html,)], "html string").select(chunking.page_text(F.col("html")).alias("t")).first().t
    assert page.split() == ["Hello", "big", "world"]


@pytest.mark.parametrize("size,budget", [(300, 4000), (3, 9), (3, 10), (3, 11), (5, 5), (5, 3), (4, 7), (1, 1)])
def test_packing_by_division_is_greedy(spark, size, budget):
    counts = [0, 1, size - 1, size, size + 1, *range(2 * size, 2 * budget + 3 * size, max(1, budget // 7)), 5 * budget + 1]
    docs = docs_of(spark, *[" ".join(["w"] * n) for n in counts])
    got = {}
    for r in chunking.packed_pieces(docs, size, budget).orderBy("doc_id", "piece").collect():
        got.setdefault(r.doc_id, []).append(r.grp)
    for i, n in enumerate(counts):
        sizes = [size] * (n // size) + [n % size] * (n % size > 0)
        assert got.get(i, []) == python_pack(sizes, budget), (n, sizes)


def test_refine_query_has_every_state(spark, root):
    """A row for each piece, with the words of all pieces so far, not only what the piece adds."""
    from tidemill.plans import catalog

    text = " ".join(["ant"] * 1000 + ["bee"] * 1000 + ["ant"] * 500)
    docs_of(spark, text, "cat", "").write.parquet(f"{root}/documents.parquet")
    got = sorted(map(tuple, catalog.QUERIES["refine_summary"](spark, root).collect()))
    assert got == [(0, 0, "ant"), (0, 1, "ant bee"), (0, 2, "ant bee"), (1, 0, "cat")]
    assert "string_agg" in catalog.ORACLES["refine_summary"]
