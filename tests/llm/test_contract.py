"""Every query of the package against its SQL, or its shape where it has none."""

import pytest

import __spark_entry__ as contract
import check_oracle
from tidemill.llm import queries

COLUMNS = {
    "op1_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op2_toxicity": {"doc_id": "bigint", "severity": "double", "grade": "int", "toxic": "boolean"},
    "op4_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op5_surrogates": {"doc_id": "bigint", "text": "string", "n_findings": "int"},
    "op7_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op8_pieces": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_has_the_rows_of_its_sql(spark, duck, small, name):
    ok, note = check_oracle.compare(spark, duck, small, name, queries.ORACLES[name])
    assert ok, note
    assert "types differ" not in note, note


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, small, name):
    assert dict(queries.QUERIES[name](spark, small).dtypes) == COLUMNS[name]


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(contract.oracle_sql())
