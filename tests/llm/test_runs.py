import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import runs

DDL = "doc_id long, text string, runs string, collapsed string, start long"


def brute(words):
    """Runs as (start, length, period): all stretches of every period, by their definition."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def of(*texts):
    number = {}
    return [list(map(tuple, r.tolist())) for r in runs.runs_of([np.array([number.setdefault(w, len(number)) for w in t], np.int64) for t in texts])]


def periodic(rng, letters, period, times, around):
    word = rng.choices(letters, k=period)
    cut = rng.randrange(period)
    return rng.choices(letters, k=rng.randrange(around)) + word * times + word[:cut] + rng.choices(letters, k=rng.randrange(around))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=80), max_size=4))
def test_two_letters(texts):
    assert of(*texts) == [brute(t) for t in texts]


def test_planted_periods():
    rng = random.Random(4)
    for case in range(400):
        letters = "abcdefghij"[: rng.choice([1, 2, 3, 10])]
        texts = [periodic(rng, letters, rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33]), rng.choice([3, 4, 5, 9]), 20) for _ in range(rng.randrange(1, 4))]
        assert of(*texts) == [brute(t) for t in texts], texts


def test_periods_of_blocks_that_are_periodic_themselves():
    rng = random.Random(5)
    for _ in range(200):
        unit = "a" * rng.randrange(1, 14) + rng.choice(["b", "ba", "bb", "ab" * rng.randrange(1, 6), "c"])
        unit = unit * rng.randrange(1, 3) + rng.choice(["", "a", "b"])
        text = "b" * rng.randrange(3) + unit * 5 + unit[: rng.randrange(len(unit))] + rng.choice(["", "c", "a"])
        assert of(text) == [brute(text)], text


def test_fibonacci_and_powers():
    a, b = "a", "ab"
    for _ in range(9):
        a, b = b, b + a
    for text in (b, b * 4, (b[:21] * 4 + "x") * 4, "a" * 1000, "ab" * 500 + "a", "a" * 500 + "b" + "a" * 500):
        assert of(text, text[::-1], "") == [brute(text), brute(text[::-1]), []]


def test_long_text_in_little_time():
    n = 300_000
    text = np.random.default_rng(1).integers(0, 50, n)
    text[100_000:] = text[100_000 + np.arange(n - 100_000) % 37_501]
    found = runs.runs_of([text, np.zeros(50_000, np.int64)])
    assert [0, 50_000, 1] in found[1].tolist()
    start, length, period = max(found[0].tolist(), key=lambda r: r[1])
    assert period == 37_501 and start + length == n and 99_990 <= start <= 100_000


def test_rows(spark):
    texts = [
        None, "", " \t\r\n", "a", "a a a a a a", "a a a a a", "x\x1cy z\xa0w " * 4, "é 日 b\x0bc " * 9, ("k l m " * 4 + "n ") * 5,
        "word " * 20_000, " ".join(f"w{i % 700}" for i in range(9000)), "q" * 200_000,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b b b b b b b"), (3, "a b " * 6), (3, "a b " * 6)]
    docs = spark.createDataFrame([(*r, "r", "c", 1) for r in rows], DDL)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()), key=str)
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = brute(words) if len(words) < 5000 else [tuple(r) for r in of(words)[0]]
        want.append((i, found, collapsed(words, found)))
    assert got == sorted(want, key=str)
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_planting(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(400)] + [(None, "a b"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = docs.select("doc_id", "text", runs.planted(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("new")).collect()
    for r in got:
        h = zlib.crc32(str(r.doc_id).encode())
        words, n = (r.text or "").split(), len((r.text or "").split())
        if r.doc_id is not None and h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert r.new.split() == words


@pytest.mark.parametrize("size", [0, 1, 5, 6])
def test_short(size):
    assert of("a" * size) == [brute("a" * size)]
