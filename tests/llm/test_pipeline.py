import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tokenizers

from tests.llm.test_neardup import brute
from tidemill.llm.packing import lower_bound

DDL = "doc_id long, text string, lang string, source string, n_chars long, toxic string, node string"


@pytest.fixture
def corpus(spark, root):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels, bad = [], [], set()
    for i in range(240):
        text = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        if i % 5 == 0:
            bad.add(i)
            text += ["vile", "rotten"] * rng.randint(1, 3)
        if i % 2 == 0:
            labels.append((i, 1, int(i in bad)))
        if i % 7 == 3:
            text.append(f"user{i}@host{i}.org")
        rows.append((i, " ".join(text)))
    rows += [(300 + i, rows[11][1]) for i in range(20)] + [(400 + i, rows[13][1] + " more") for i in range(5)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "long " * 30000)]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], DDL).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return rows, bad


def test_against_brute_force(spark, root, corpus):
    rows, bad = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    (_, toxic), (_, copies), (_, private), (_, pack) = corpus_pipeline.STAGES
    clean = toxic(spark, docs, root)
    assert clean.schema == docs.schema
    left = [r for r in rows if r[0] not in bad]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in clean.collect()))) == sorted(map(str, left))
    once = copies(spark, clean, root)
    assert once.schema == docs.schema
    kept = {d for d, _, _, own in brute([r for r in left if r[0] is not None]) if own} | {None}
    assert sorted(map(str, (r["doc_id"] for r in once.collect()))) == sorted(map(str, kept))
    named = private(spark, once, root)
    assert named.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in named.collect()}
    assert set(texts) == kept
    for doc, text in rows:
        if doc in kept:
            assert ("@" in (text or "")) == (texts[doc] != text)
            assert f"user{doc}@host{doc}.org" not in (texts[doc] or "")
    tokens = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {d: len(tokens.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    packed = pack(spark, named, root).collect()
    by = {}
    for r in packed:
        by[r["doc_id"]] = by.get(r["doc_id"], 0) + r["length"]
    assert by == sizes
    assert len({r["sequence_id"] for r in packed}) <= lower_bound(np.array([r["length"] for r in packed]), 1024) + 3
    whole = corpus_pipeline.run(spark, root)
    assert whole.columns == pack(spark, named, root).columns
    assert sorted(map(str, ((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()))) == sorted(
        map(str, ((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed))
    )


def test_empty_tables(spark, root):
    spark.createDataFrame([], DDL).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    assert corpus_pipeline.run(spark, root).collect() == []
