"""All registered queries."""

from tidemill.plans import queries_corpus, queries_files, queries_relational, queries_text, queries_vectors  # noqa: F401
from tidemill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
