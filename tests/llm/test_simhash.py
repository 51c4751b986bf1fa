import random
import re

import numpy as np
import pytest
import xxhash

from tidemill.llm import queries, simhash

DDL = "doc_id long, text string, node long, component string, entry string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    names = list(range(len(prints)))

    def top(x):
        while names[x] != x:
            x = names[x]
        return x

    for x in range(len(prints)):
        for y in range(x):
            if (prints[x][1] ^ prints[y][1]).bit_count() <= 4:
                names[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(prints):
        if i is not None:
            least[top(x)] = min(i, least.get(top(x), i))
    return sorted(((i, f"{p:016x}", least.get(top(x))) for x, (i, p) in enumerate(prints)), key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "c", "e") for r in rows], DDL)
    got = simhash.near_copies(docs).collect()
    return sorted(((r.doc_id, f"{r.node % 2**64:016x}", r.component_id) for r in got), key=str)


def near(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice("alpha beta gamma delta".split())
    return " ".join(words)


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(30, 300))) for _ in range(n)]
    return rng, texts


def test_code_is_perfect():
    assert len(set(simhash.ERROR.tolist())) == 2048
    assert set(simhash.MANY.tolist()) == {1, 6}


def test_words_within_two_bits_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    for flips in (0, 1, 2):
        other = words.copy()
        for row in range(len(words)):
            for bit in rng.choice(23, flips, replace=False):
                other[row] ^= 1 << bit
        (a, in_a), (b, in_b) = simhash.keys(words), simhash.keys(other)
        assert all(set(x[m]) & set(y[k]) for x, m, y, k in zip(a, in_a, b, in_b))


def test_every_pair_within_four_bits_shares_an_entry():
    rng = random.Random(2)
    for _ in range(1500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(0, 5)):
            b ^= 1 << bit
        # Also with all changes in one or two segments.
        low, size = rng.choice(simhash.SEGMENTS)
        c = a
        for bit in rng.sample(range(low, low + size), rng.randrange(0, 5)):
            c ^= 1 << bit
        got, of = simhash.entries(np.array([a, b, c], np.uint64).view(np.int64))
        held = [set(got[of == i].tolist()) for i in range(3)]
        assert held[0] & held[1] and held[0] & held[2]
        assert all(len(h) == (of == i).sum() for i, h in enumerate(held))


@pytest.mark.parametrize("text", ["", " \t\r\n\x0b\x0c", "one", "a b c", "A b\x85c d e", "x " * 700, "é日 \x1c \xa0 y z w", "q" * 100_000, "a b c d " * 20_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == brute_print(text)


def test_against_brute_force(spark):
    rng, texts = corpus(60)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, near(rng, texts[i % 20], rng.randrange(0, 6))) for i in range(120)]
    rows += [(None, texts[0]), (None, None), (None, "lone row without an id"), (7, texts[7]), (7, texts[8]), (900, ""), (901, " "), (902, "a"), (902, "a")]
    rng.shuffle(rows)
    got = found(spark, rows)
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(rows) - 40


def test_a_crowd_of_near_copies(spark):
    rng, texts = corpus(3, 8)
    long = " ".join(texts * 3)
    rows = [(i, near(rng, long, rng.randrange(0, 8))) for i in range(500)] + [(1000 + i, t) for i, t in enumerate(texts)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_query_on_the_small_tables(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_simhash"](spark, small)
    assert dict(got.dtypes) == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == brute(rows)
