import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from tidemill.llm.packing import ByteTokens, best_fit_decreasing, cut_documents, lower_bound, pack_documents, pack_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
DDL = "doc_id long, text string, part int, sequence long, length string"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokens():
    with open(PATH, encoding="utf-8") as file:
        return ByteTokens(file.read())


def test_ids_are_the_librarys(library, tokens):
    rng = random.Random(3)
    alphabet = "  \n\t\r\x0b\x1c\x85\xa0 　 abcdé日👍'stll123!?.<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["a <|endoftext|> b", " \n <|endoftext|>x", "a" * 50000, " " * 5000, "\n" * 5000]
    for text in texts:
        assert np.frombuffer(tokens.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)[:80]


def test_ids_of_a_text_the_fast_library_gives_up_on(library, tokens, monkeypatch):
    class Failing:
        def encode_to_numpy(self, *_, **__):
            raise ValueError

    monkeypatch.setattr(tokens, "fast", Failing())
    assert np.frombuffer(tokens.encode("some text"), "<u4").tolist() == library.encode("some text", add_special_tokens=False).ids


def fewest(lengths, capacity):
    """The least number of bins, by trying all."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity:
                place(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1:]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def test_bound_is_never_above_the_optimum_and_often_reaches_it():
    rng, reached = random.Random(5), 0
    for _ in range(200):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 8))), reverse=True)
        least, optimum = lower_bound(np.array(lengths), 20), fewest(lengths, 20)
        assert least <= optimum
        reached += least == optimum
    assert reached > 150


def test_best_fit_takes_the_fullest_sequence():
    where, place, used = best_fit_decreasing(np.array([7, 6, 3, 2, 2]), 10)
    assert used == 2 and where.tolist() == [0, 1, 0, 1, 1] and place.tolist() == [0, 0, 7, 6, 8]


def sound(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for members in by.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by)


def test_repacking_keeps_every_piece(spark):
    rng = random.Random(7)
    rows = [(i, 0, 0, rng.choice([61, 52, 34, 27, 100, 45, 55]), i) for i in range(900)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = {group: pack_pieces(pieces, 100, group_rows=group, rounds=4).collect() for group in (60, 2000)}
    for result in packed.values():
        assert sorted((r["doc_id"], r["length"]) for r in result) == sorted((r[0], r[3]) for r in rows)
    least = lower_bound(np.array([r[3] for r in rows]), 100)
    assert least <= sound(packed[2000], 100) <= sound(packed[60], 100) + 2 <= least * 1.1 + 5


def test_documents(spark, library):
    texts = [None, "", "one two", "one two", "word " * 3000, "x" * 20000, "a <|endoftext|>", " ".join(str(i) for i in range(1023))]
    docs = spark.createDataFrame([(i if i else None, t, 1, 2, "c") for i, t in enumerate(texts)], DDL)
    rows = pack_documents(docs, PATH).collect()
    sound(rows, 1024)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n, r in enumerate(sorted(by[i if i else None], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at) and (n == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(ids[at: at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and (len(by[i if i else None]) == 1) == (len(ids) <= 1024)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "same text", 1, 2, "c")] * 50, DDL)
    rows = pack_documents(docs, PATH).collect()
    assert len(rows) == 50 and sound(rows, 1024) == 1
    assert pack_documents(docs.limit(0), PATH).collect() == []
    assert len(list(itertools.chain(cut_documents(docs, PATH).collect()))) == 50
