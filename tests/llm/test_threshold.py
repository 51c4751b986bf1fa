import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemill.llm.grid import Best
from tidemill.llm.threshold import threshold_search, top_k

DDL = "vec_id long, embedding array<float>, rank int, score string, block long"


def whole(x):
    return math.floor(64 * float(np.float32(x)))


def shown(score):
    return max(-(2**63), min(2**63 - 1, score))


def brute(rows, queries, k):
    usable = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {(i, tuple(v)) for i, v in usable if i in queries}
    out = []
    for q, v in asked:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, shown(-s)) for n, (s, i) in enumerate(found)]
    return sorted(out)


def run(spark, rows, queries, k, **more):
    df = spark.createDataFrame([(i, v, 1, "s", 9) for i, v in rows], DDL)
    return sorted(map(tuple, top_k(df, df.where(F.col("vec_id").isin(queries)), k, **more).collect()))


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(700)]
    rows += [(700 + i, [0.5] * 6) for i in range(60)] + [(3, rows[3][1]), (4, [9.0] * 6), (4, rows[4][1])]
    queries = [0, 3, 4, 50, 701, 702]
    assert run(spark, rows, queries, 20) == brute(rows, queries, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, -1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]),
        (7, [0.0, 0.0]), (8, [1e30, -1e30]), (9, [1.0, 2.0, 3.0]), (10, [3e5, -3e5]), (11, [0.01, 0.02]),
    ]
    queries = list(range(12))
    assert run(spark, rows, queries, 3) == brute(rows, queries, 3)
    assert run(spark, rows, [9], 3) == []
    assert run(spark, [], [1], 3) == []


def test_numbers_of_any_size(spark):
    """Against Python's integers: around 2**24, in 64 bits, and far beyond them."""
    rng = random.Random(3)
    for size in (3e5, 1e9, 1e12, 1e30, 3e38):
        rows = [(i, [rng.uniform(-1, 1) * size for _ in range(4)]) for i in range(150)] + [(500 + i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(50)]
        rows += [(600, [3e5, 4e5, 0.0, 0.0]), (601, [4e5, 3e5, 0.0, 0.0]), (602, [3e5, 3e5, 0.0, 0.0])]
        assert run(spark, rows, [0, 7, 510, 600], 30, group_rows=70) == brute(rows, [0, 7, 510, 600], 30)


def test_clamped_no_more(spark):
    rows = [(1, [1.0]), (2, [300_000.0]), (3, [400_000.0])]
    assert run(spark, rows, [1], 2) == [(1, 1, 3, 64 * 64 * 400_000), (1, 2, 2, 64 * 64 * 300_000)]


def test_search_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(2)
    # One long component, so its list alone nearly settles the order.
    vectors = np.floor(np.hstack([rng.normal(size=(4000, 1)) * 1000, rng.normal(size=(4000, 2))]))
    query, ids = np.array([[3.0, 1.0, -1.0]]), np.arange(4000)

    class Counting(np.ndarray):
        rows = 0

        def __getitem__(self, item):
            out = super().__getitem__(item)
            if isinstance(item, np.ndarray) and item.dtype == bool:
                Counting.rows += len(out)
            return out

    best = Best(5, np.int64, np.iinfo(np.int64).min)
    threshold_search((np.array([-1]), query), (ids, vectors.view(Counting)), [best])
    scores = vectors @ query[0]
    assert best.ids.tolist() == np.lexsort((ids, -scores))[:5].tolist()
    assert Counting.rows < 1000
