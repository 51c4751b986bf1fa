import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemill.llm import merkle

DDL = "doc_id long, text string, lang string, source string, n_chars long, leaf string, place string, root string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, fan):
    """The root, and each node's proof as (before, after) by level."""
    proofs = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, below = [], []
        for at in range(0, len(nodes), fan):
            run = nodes[at: at + fan]
            for j in range(len(run)):
                for i in under[at + j]:
                    proofs[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            parents.append(sha(*run))
            below.append([i for u in under[at: at + fan] for i in u])
        nodes, under = parents, below
    return nodes[0], proofs


def brute(rows, fan=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    out, trees = [], []
    for lang in langs:
        members = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, *climb([leaf(r) for r in members], fan)))
    if not trees:
        return []
    root, above = climb([t[1] for t in trees], fan)
    for (members, subroot, proofs), higher in zip(trees, above):
        for row, proof in zip(members, proofs):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, 1 if changed else 0)
            for before, after in proof + higher:
                node = sha(before, node, after)
            out.append((row[0], leaf(row), subroot, root, sha(*[b + a for b, a in proof + higher]), node, node == root))
    return sorted(out, key=str)


def found(spark, rows, fan=2, levels=10):
    docs = spark.createDataFrame([(*r, "l", "p", "r") for r in rows], DDL)
    got = merkle.document_manifest(docs, fan, levels)
    got = got.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps")).alias("folded"),
    )
    return sorted([(*r, r[5] == r[3]) for r in got.collect()], key=str)


def docs(n, lang="en", start=0):
    return [(i, f"text {i} é日", lang, f"s{i % 3}", i % 50) for i in range(start, start + n)]


@pytest.mark.parametrize("fan,levels,sizes", [(2, 2, (1, 2, 3, 7, 16, 17, 33)), (3, 1, (1, 4, 10, 28)), (2, 10, (5, 1030))])
def test_against_brute_force(spark, fan, levels, sizes):
    rows = [r for at, n in enumerate(sizes) for r in docs(n, f"l{at}", 10_000 * at)]
    assert found(spark, rows, fan, levels) == brute(rows, fan)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = docs(20) + docs(3) + [(5, None, "en", None, None), (None, "x", "en", "s", 1), (None, None, None, None, None)]
    rows += [(100 + i, "y" * 200_000, None, "", 2**63 - 1) for i in range(3)] + [(200, "", "", "", 0)] * 5 + [(14, "z", "Ω", "s", 7), (15, "z", "a", "s", 7)]
    assert found(spark, rows, 2, 2) == brute(rows)


@pytest.mark.parametrize("rows", [[], docs(1), docs(1) + docs(1, "fr", 9)])
def test_few_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_a_change_is_found_in_the_changed_rows_only(spark):
    rows = docs(300)
    got = found(spark, rows, 2, 3)
    assert {r[0] for r in got if not r[6]} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert len({r[3] for r in got}) == 1


def test_a_hot_group_is_cut_into_blocks(spark):
    rows = docs(700) + docs(5, "fr", 5000)
    plan = merkle._climbed(spark.createDataFrame([(("en",), i, 700, "n") for i in range(700)], "whose struct<g:string>, place long, n long, node string"), 2, 4)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One shuffle and one sort for all levels, by group and block.
    assert text.count("Exchange hashpartitioning(whose") == 1 and "block" in text and text.count("Sort [") == 1
    assert found(spark, rows, 2, 4) == brute(rows)
