import public_tokenizers
import pytest
import sentencepiece

from tidemill.llm import token_counts
from tidemill.llm.pieces import Pieces
from tidemill.llm.token_counts import Summary, count_tokens, frequent_words, op1_token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
DDL = "doc_id long, text string, n_tokens string, n_bytes int, __text string"
TEXTS = [None, "", " ", "a", "Hello  world\n\n x", "</s> <s> <0x0A> ▁", "日本語 ñ👍", "word " * 30000, "a" * 5000, "same", "same", "\0 a\0b"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("frequent", [[], ["▁word", "▁same", "▁never"]])
def test_counts_are_the_librarys(spark, library, frequent):
    rows = [(i if i else None, t, "x", 1, "y") for i, t in enumerate(TEXTS)]
    got = count_tokens(spark.createDataFrame(rows, DDL), PATH, frequent)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DDL)
    assert frequent_words(docs, Pieces.load(PATH)) == []
    assert count_tokens(docs, PATH, []).collect() == []


def test_frequent_words_cover_all_rows(spark):
    docs = spark.createDataFrame([(i, f"common w{i}") for i in range(3000)], "doc_id long, text string").repartition(5)
    assert frequent_words(docs, Pieces.load(PATH), size=1) == ["▁common"]


def test_summary_forgets_rare_words_only():
    summary = Summary(10)
    for i in range(500):
        summary.add(["often"] * 3 + [f"rare{i}"])
    merged = Summary(10)
    merged.merge(summary.pack())
    merged.merge(Summary(10).pack())
    assert merged.counts["often"] == 1500 and len(merged.counts) <= 10


def test_query_on_whole_table(spark, small, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in op1_token_counts(spark, small).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 4096, len(texts[r["doc_id"]].encode()))


def test_frequent_words_of_the_query_come_from_all_rows(spark, root, monkeypatch):
    spark.range(30_000).selectExpr("id AS doc_id", "concat('w', id) AS text").write.parquet(f"{root}/documents.parquet")
    counted = []
    monkeypatch.setattr(token_counts, "frequent_words", lambda docs, model: counted.append(docs.count()) or [])
    assert op1_token_counts(spark, root).count() == 30_000 and counted == [30_000]
