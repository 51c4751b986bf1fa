"""Pages asked for by token: every row once, in order, with a token until the last page."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators import corpus


@pytest.mark.parametrize("size", [1, 7, 10])
def test_pages_follow_one_another(spark, size):
    sizes = {"a": 23, "b": 10, "c": 1}
    rows = [(parent, i * 3) for parent, n in sizes.items() for i in range(n)]
    children = spark.createDataFrame(rows, "parent string, id long").repartition(5)
    tokens = spark.createDataFrame([(p, None) for p in sizes], "parent string, token long")
    seen = {p: [] for p in sizes}
    for _ in range(30):
        page = corpus.next_pages(children, tokens, "parent", "id", size).orderBy("parent", "id").collect()
        if not page:
            break
        following = {}
        for r in page:
            seen[r.parent].append(r.id)
            following[r.parent] = r.next_page_token
        for parent, token in following.items():
            # The token is the last key of a page that others follow.
            assert token == (seen[parent][-1] if len(seen[parent]) < sizes[parent] else None)
        rest = [(p, t) for p, t in following.items() if t is not None]
        if not rest or size == 1 and len(seen["a"]) > 3:
            break
        tokens = spark.createDataFrame(rest, "parent string, token long")
    for parent, n in sizes.items():
        assert seen[parent] == [i * 3 for i in range(n)][: len(seen[parent])] and (size == 1 or len(seen[parent]) == n)


def test_page_size_and_limits(spark):
    children = spark.range(5).select(F.lit("p").alias("parent"), "id")
    tokens = spark.createDataFrame([("p", None), ("unknown", 1)], "parent string, token long")
    with pytest.raises(ValueError):
        corpus.next_pages(children, tokens, "parent", "id", 101)
    plan = corpus.next_pages(children, tokens, "parent", "id", 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
