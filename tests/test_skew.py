"""Hot keys: same results as brute force, and no task that gathers a group."""

import bisect
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.operators import skew, windows
from tidemill.operators.vectors import centroid_distances


def hot_rows(n=3000, groups=40):
    """A third of all rows in group 0."""
    rng = random.Random(5)
    return [(i, 0 if i % 3 == 0 else rng.randrange(1, groups), rng.randrange(100)) for i in range(n)]


def brute_totals(rows):
    """For (key, group, value): sums of what comes before in the group, by key."""
    out, running = {}, {}
    for key, grp, v in sorted(rows, key=lambda r: (r[0], str(r[1]))):
        out[grp, key] = running.get(grp, 0)
        running[grp] = running.get(grp, 0) + v
    return out


@pytest.mark.parametrize("blocks", [1, 7, 64])
def test_totals_before_matches_brute_force(spark, blocks):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "key long, grp long, v long")
    got = {(r.grp, r.key): r.before for r in skew.totals_before(df, ["grp"], "key", "v", "before", blocks=blocks).collect()}
    assert got == brute_totals(rows) and len(got) == len(rows)


def test_hashed_keys_and_null_groups(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(-(2**63), 2**63), None if i % 3 == 0 else i % 5, 1) for i in range(4000)]
    df = spark.createDataFrame(rows, "key long, grp long, v long")
    before = skew.totals_before(df, ["grp"], "key", "v", "before", blocks=100)
    assert {(r.grp, r.key): r.before for r in before.collect()} == brute_totals(rows)
    # The null group has a third of the rows, and is cut by keys where it is, into many small blocks.
    text = before._jdf.queryExecution().toString()
    assert "Window [sum" in text and "Exchange hashpartitioning(__whose" in text
    cut = skew.cuts_of(df.select(F.struct("grp").alias("__whose"), F.struct("key").alias("__place")), 100).collect()
    cuts = next(r["__cuts"] for r in cut if r["__whose"].grp is None)
    sizes = Counter(bisect.bisect_right([c.key for c in cuts], key) for key, grp, _ in rows if grp is None)
    assert len(cuts) > 15 and max(sizes.values()) < 400


def test_nothing_runs_before_the_result_is_asked_for(spark):
    seen = []
    df = spark.range(1000).selectExpr("id % 3 AS grp", "id AS key", "raise_error('read') IS NULL AS v").withColumn("v", F.col("v").cast("long"))
    seen.append(skew.totals_before(df, ["grp"], "key", "v", "before"))
    with pytest.raises(Exception, match="read"):
        seen[0].collect()


def test_rows_are_shuffled_once_and_only_once(spark, small):
    said = spark.read.parquet(f"{small}/conversations.parquet")
    plan = skew.positions(said, ["conv_id"], "turn", "role", "text")._jdf.queryExecution().optimizedPlan().toString()
    # One window, over the rows.
    assert plan.count("Window [") == 1 and "Sort [" not in plan
    counted = skew.positions(said, ["conv_id"], "turn", "role", "text").groupBy("conv_id").agg(F.min("position"), F.max("position"), F.count("*"))
    assert all(r[1] == 0 and r[2] == r[3] - 1 for r in counted.collect())


def test_keys_may_be_texts_and_null(spark):
    rows = [(f"g{i % 3}", None if i % 7 == 0 else f"k{i % 50:02d}", i) for i in range(600)]
    got = skew.positions(spark.createDataFrame(rows, "grp string, key string, tie int"), ["grp"], "key", "tie", blocks=32).collect()
    want = {}
    for grp, key, tie in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2])):
        want[tie] = want.get(("n", grp), 0)
        want["n", grp] = want[tie] + 1
    assert all(r.position == want[r.tie] for r in got) and len(got) == 600


def test_positions_count_from_zero(spark):
    rows = [(r[0] // 4, r[1], r[2]) for r in hot_rows(600)]
    df = spark.createDataFrame(rows, "key long, grp long, tie long")
    got = skew.positions(df, ["grp"], "key", "tie", blocks=16).collect()
    by = {}
    for r in got:
        by.setdefault(r.grp, []).append((r.position, r.key, r.tie))
    for placed in by.values():
        assert [p for p, _, _ in sorted(placed)] == list(range(len(placed)))
        assert [x[1:] for x in sorted(placed)] == sorted(x[1:] for x in placed)
    assert skew.positions(df.limit(0), ["grp"], "key").collect() == []


def test_class_distances_read_their_rows_once(spark, small):
    vectors_ = spark.read.parquet(f"{small}/embeddings.parquet")
    plan = centroid_distances(vectors_, "label", "embedding")._jdf.queryExecution().executedPlan().toString()
    # Once for the rows and once for the centroids.
    assert plan.count("FileScan parquet") == 2


def test_long_conversation_is_paged(spark):
    rows = [(0, i, "user", f"m{i}") for i in range(300)] + [(1, 0, "system", "s"), (1, 1, "robot", "r")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pages = windows.transcript_pages(messages, page=64).orderBy("conv_id", "page").collect()
    assert [p.n_messages for p in pages] == [64, 64, 64, 64, 44, 2]
    whole = "\n".join(p.transcript for p in pages if p.conv_id == 0)
    assert whole == "\n".join(f"Human: m{i}" for i in range(300))
    assert pages[-1].transcript == "System: s\nrobot: r"

    asked = spark.createDataFrame([(0, 0), (0, 63), (0, 64), (0, 299), (1, 0), (5, 1)], "conv_id long, turn long")
    seen = {}
    for r in windows.chat_history(messages, asked).collect():
        seen.setdefault((r.conv_id, r.asked_turn), []).append((r.position, r.text))
    for turn in (0, 63, 64, 299):
        assert sorted(seen[0, turn]) == [(i, f"m{i}") for i in range(turn + 1)]
    assert seen[1, 0] == [(0, "s")] and (5, 1) not in seen
    lengths = {(r.conv_id, r.turn): r.n_messages for r in windows.history_length(messages).collect()}
    assert all(lengths[0, i] == i + 1 for i in range(300)) and lengths[1, 1] == 2


def test_running_size_over_many_blocks(spark):
    rows = [(0, i, "user", "x " * (i % 5)) for i in range(5000)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = windows.running_size(messages, F.regexp_count("text", F.lit(r"\S+")).cast("long")).orderBy("turn").collect()
    total = 0
    for i, row in enumerate(got):
        total += i % 5
        assert row.running_size == total


def test_context_budget_keeps_the_best_prefix(spark):
    rows = [(0, i, 1.0 - i / 100, t) for i, t in enumerate([5, 0, 4, 3, 1])]
    passages = spark.createDataFrame(rows, "query_id long, passage_id long, score double, tokens long")
    kept = windows.context_budget(passages, 9).orderBy("rank").collect()
    assert [(r.passage_id, r.used) for r in kept] == [(0, 5), (2, 9)]


def test_repeated_turns_have_the_same_pages(spark):
    rows = [(0, i % 4, "user", f"m{i:04d}") for i in range(1000)] + [(1, 0, "user", "x")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pages = windows.transcript_pages(messages, page=16).orderBy("conv_id", "page").collect()
    assert [p.n_messages for p in pages] == [16] * 62 + [8, 1]
    whole = "\n".join(p.transcript for p in pages if p.conv_id == 0)
    assert whole == "\n".join(f"Human: {r[3]}" for r in sorted(rows[:1000], key=lambda r: (r[1], r[3])))


@pytest.mark.parametrize("n", [64, 65, 100, 1000])
def test_pages_follow_one_rule(spark, n):
    messages = spark.createDataFrame([(0, i, "user", "t") for i in range(n)], "conv_id long, turn long, role string, text string")
    sizes = [r.n_messages for r in windows.transcript_pages(messages).orderBy("page").collect()]
    assert sizes == [64] * (n // 64) + [n % 64] * (n % 64 > 0)
