"""The corpus pipeline: toxic documents go, one of each group of near copies stays, private data gets
surrogates, and what is left is packed into sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows it is given, and all but the last give
back the columns of ``docs``. Between stages the rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import neardup, packing, pii, toxicity
from tidemill.llm.common import table, written

PACKED_WITH = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the severity model, fitted on the labelled rows, does not call toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose id is the smallest of their group of near copies; rows without an id stay.

    Rows that share an id are one document: they stay or go together.
    """
    gone = written(neardup.near_copies(docs).where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "gone")
    if gone.count() <= neardup.MOST_SENT:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with private data replaced by surrogates."""
    return pii.replace_private(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(PACKED_WITH))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("surrogates", replace_private_data),
    ("packing", pack),
]

# SQL has no tokenizer and no fitted model: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = written(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
