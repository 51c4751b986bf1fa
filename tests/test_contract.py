"""Every registered query against its SQL, and the plans of some of them."""

import pytest

import __spark_entry__ as contract
import check_oracle
from tidemill.plans import catalog

NAMES = sorted(catalog.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, small, name):
    ok, note = check_oracle.compare(spark, duck, small, name, contract.oracle_sql().get(name))
    assert ok, note
    assert "types differ" not in note, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def plan(spark, small, name):
    return contract.queries()[name](spark, small)._jdf.queryExecution().toString()


# Vector search runs numpy in tasks by design and HTML the standard parser; nothing else leaves the JVM.
IN_PYTHON = {
    "cosine_topk", "filtered_topk", "grounded_answer", "context_budget", "html_passages", "html_passages_flat",
}


@pytest.mark.parametrize("name", sorted(set(NAMES) - IN_PYTHON - {"gold_sales_stream"}))
def test_plan_has_no_row_udf_and_no_cross_join(spark, small, name):
    text = plan(spark, small, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_filters_reach_the_scan(spark, small):
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan(spark, small, "sales_year_in")
    assert "EqualTo(lang" in plan(spark, small, "metadata_filter").replace("Or(EqualTo", "EqualTo")


def test_scans_read_needed_columns_only(spark, small):
    text = plan(spark, small, "sales_by_type")
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in text


def test_ranked_queries_limit_before_the_shuffle(spark, small):
    for name in ("stratified_sample", "cap_turns", "train_test_split", "cosine_topk"):
        assert "Partial" in plan(spark, small, name).split("WindowGroupLimit", 1)[1], name


def test_themes_shuffle_texts_once(spark, small):
    text = contract.queries()["theme_summary"](spark, small)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "word#" in line]
    assert not wide


@pytest.mark.parametrize("blocked", ["tidemill.llm", "ahocorasick", "sentencepiece", "corpus_pipeline"])
def test_a_missing_library_costs_its_queries_only(blocked):
    """In a process of its own, where an import fails."""
    import os
    import subprocess
    import sys

    code = f"""
import sys
class Block:
    def find_spec(self, name, *_):
        if name == {blocked!r} or name.startswith({blocked!r} + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as contract
from tidemill.plans import catalog
assert set(catalog.QUERIES) <= set(contract.queries()) and set(catalog.ORACLES) <= set(contract.oracle_sql())
print("fine", "pipeline" in contract.queries())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.stdout.startswith("fine"), done.stderr[-2000:]
    assert blocked != "corpus_pipeline" or "fine False" in done.stdout
