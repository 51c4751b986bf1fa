import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemill.functions.html import passages
from tidemill.operators import corpus
from tidemill.operators.filters import Condition, KeyFilter, metadata_filter


def test_excluded_tags_and_entities():
    html = "<body><p>one &amp; two</p><script>x</script><noscript><p>no</p></noscript><style>s</style><p>three</p></body>"
    assert passages(html, 200, True) == ["one & two three"]
    assert passages(html, 200, True, frozenset()) == ["one & two x no s three"]


def test_siblings_are_merged_up_to_the_limit():
    html = "<div>" + "".join(f"<p>{'w ' * 10}</p>" for _ in range(10)) + "</div>"
    assert [len(p.split()) for p in passages(html, 45, True)] == [40, 40, 20]
    assert [len(p.split()) for p in passages(html, 45, False)] == [10] * 10
    assert [len(p.split()) for p in passages(html, 100, False)] == [100]


def test_long_paragraph_is_cut_and_whole():
    words = [f"w{i}" for i in range(450)]
    html = f"<article><h1>title</h1><p>{' '.join(words)}</p><p>end</p></article>"
    got = passages(html, 200, True)
    assert all(len(p.split()) <= 200 for p in got)
    assert " ".join(got).split() == ["title", *words, "end"]


def test_odd_html_loses_nothing():
    assert passages("", 10, True) == []
    assert passages("bare text", 10, True) == ["bare text"]
    assert " ".join(passages("<p>a<p>b</div></i>c<br>d", 2, False)) == "a b c d"
    deep = "<b>" * 5000 + "x y" + "</b>" * 5000
    assert passages(deep, 1, True) == ["x", "y"]


def test_page_passages(spark):
    pages = spark.createDataFrame([(1, "<p>a b</p><p>c</p>"), (2, None), (3, "<p></p>")], "page_id long, html string")
    assert [tuple(r) for r in corpus.page_passages(pages, 2, True).collect()] == [(1, 0, "a b"), (1, 1, "c")]


def test_names_are_bounded_and_repeatable(spark):
    df = spark.createDataFrame([("A Blog, for Developers! " * 5,), ("***",)], "title string")
    name = corpus.resource_name("corpora", F.col("title"))
    first, again = ([r.n for r in df.select(name.alias("n")).collect()] for _ in range(2))
    assert first == again
    assert all(len(n.split("/")[1]) <= 40 for n in first)
    assert first[0].startswith("corpora/a-blog-for-developers-a-bl") and len(first[1].split("/")[1]) == 12


def test_pages_and_tokens(spark):
    children = spark.createDataFrame([("p", i * 3) for i in range(25)] + [("q", 1)], "parent string, id long")
    pages = corpus.pages_of(children, "parent", "id")
    assert {(r.parent, r.page): r["count"] for r in pages.groupBy("parent", "page").count().collect()} == {
        ("p", 0): 10, ("p", 1): 10, ("p", 2): 5, ("q", 0): 1}
    token, seen = None, []
    while rows := corpus.next_page(children.where("parent = 'p'"), "id", token).collect():
        seen += [r.id for r in rows]
        token = seen[-1]
    assert seen == [i * 3 for i in range(25)]
    with pytest.raises(ValueError):
        corpus.pages_of(children, "parent", "id", size=101)


def test_quotas(spark):
    meta = F.map_from_entries(F.transform(
        F.sequence(F.lit(1), F.col("keys")), lambda i: F.struct(i.cast("string"), corpus.metadata(number=i))))
    corpora = spark.createDataFrame([(f"corpora/{'n' * 41 if i == 0 else i}", "d" * 129 if i == 1 else "d") for i in range(6)],
                                    "name string, display_name string")
    docs = spark.createDataFrame([("c/d1", "c", "t", 20), ("c/d2", "c", "t" * 513, 21)],
                                 "name string, corpus string, display_name string, keys int").withColumn("custom_metadata", meta)
    eleven = corpus.metadata(strings=F.array(*[F.lit(str(i)) for i in range(11)]))
    chunks = spark.createDataFrame([("k1", "c", "w " * 2043), ("k2", "c", "w " * 2044)], "name string, corpus string, text string")
    chunks = chunks.withColumn("custom_metadata", F.create_map(F.lit("tags"), eleven))
    found = {(r.rule, r.key): r.observed for r in corpus.quota_violations(corpora, docs, chunks, {"documents_per_corpus": 1}).collect()}
    assert found == {
        ("corpora", "all"): 6, ("name_chars", "corpora/" + "n" * 41): 41, ("corpus_display_chars", "corpora/1"): 129,
        ("documents_per_corpus", "c"): 2, ("document_display_chars", "c/d2"): 513, ("metadata_keys", "c/d2"): 21,
        ("tokens_per_chunk", "k2"): 2044, ("list_values", "k1"): 11, ("list_values", "k2"): 11,
    }


def test_delete_cascades_only_with_force(spark):
    corpora = spark.createDataFrame([("a",), ("b",), ("empty",)], "name string")
    docs = spark.createDataFrame([("a", "d1"), ("b", "d2")], "corpus string, name string")
    chunks = spark.createDataFrame([("a", "c1"), ("a", "c2"), ("b", "c3")], "corpus string, name string")
    doomed = corpora.where("name = 'a'")
    with pytest.raises(corpus.FailedPrecondition):
        corpus.delete_corpora(doomed, corpora, docs, chunks)
    left = corpus.delete_corpora(doomed, corpora, docs, chunks, force=True)
    assert [df.count() for df in left] == [2, 1, 1]
    left = corpus.delete_corpora(corpora.where("name = 'empty'"), corpora, docs, chunks)
    assert [df.count() for df in left] == [2, 2, 3]


ROWS = [(1, 2021, "drama", ["x", "Blog"]), (2, 2005, "action", ["Blog"]), (3, 2015, "drama", ["y"]), (4, 2021, "jazz", ["Blog"])]


def test_metadata_filter(spark):
    df = spark.createDataFrame(ROWS, "id long, year int, genre string, tags array<string>")

    def ids(*filters):
        return sorted(r.id for r in df.where(metadata_filter(filters)).collect())

    year = KeyFilter("year", [Condition("GREATER_EQUAL", 2020), Condition("LESS", 2010)])
    genre = KeyFilter("genre", [Condition("EQUAL", "drama"), Condition("EQUAL", "action")])
    assert ids(year, genre) == [1, 2]
    assert ids(year, genre, KeyFilter("tags", [Condition("INCLUDES", "x")])) == [1]
    assert ids(KeyFilter("tags", [Condition("EXCLUDES", "Blog")])) == [3]
    between = [Condition("GREATER_EQUAL", 2010), Condition("LESS", 2020)]
    assert ids(KeyFilter("year", between, combine="and")) == [3]
    assert ids() == [1, 2, 3, 4]
    for bad in (
        [KeyFilter("genre", [Condition("EQUAL", "a"), Condition("EQUAL", "b")], combine="and")],
        [year, year], [KeyFilter("year", [])], [KeyFilter("year", [Condition("LIKE", 1)])],
    ):
        with pytest.raises(ValueError):
            metadata_filter(bad)


def test_html_helper_runs_where_the_package_is_missing(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(passages))
    code = "import pickle; print(pickle.load(open('f', 'rb'))('<p>a</p><p>b</p>', 9, True, frozenset()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.strip() == "['a b']", done.stderr
