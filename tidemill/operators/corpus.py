"""Corpus, document and chunk tables: names, metadata, listing, quotas, deletion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import html as html_helper
from tidemill.functions.html import EXCLUDED, passages
from tidemill.functions.text import token_count
from tidemill.operators.skew import positions

# Executors need not have this package: the helper travels with its tasks.
cloudpickle.register_pickle_by_value(html_helper)

# Limits of the store, and the page and batch sizes of its requests.
QUOTAS = {
    "corpora": 5,
    "documents_per_corpus": 10_000,
    "chunks_per_corpus": 1_000_000,
    "tokens_per_chunk": 2_043,
    "metadata_keys": 20,
    "list_values": 10,
    "name_chars": 40,
    "corpus_display_chars": 128,
    "document_display_chars": 512,
}
BATCH_SIZE = 100
PAGE_DEFAULT, PAGE_MAX = 10, 100


def resource_name(kind: str, display: Column, *content: Column, parent: Column | None = None) -> Column:
    """``kind/slug-suffix``: a slug of the display name and 12 hex digits of its content's hash.

    The id has at most 40 characters, and the same content always gets the same name.
    """
    slug = F.regexp_replace(F.lower(display), "[^a-z0-9]+", "-")
    slug = F.regexp_replace(F.substring(slug, 1, 27), "^-|-$", "")
    digest = F.substring(F.sha2(F.concat_ws("|", display, *content), 256), 1, 12)
    name = F.concat(F.lit(f"{kind}/"), F.concat_ws("-", F.nullif(slug, F.lit("")), digest))
    return name if parent is None else F.concat(parent, F.lit("/"), name)


def metadata(string: Column | None = None, strings: Column | None = None, number: Column | None = None) -> Column:
    """One metadata value: a string, a list of strings, or a number."""
    return F.struct(
        (F.lit(None) if string is None else string).cast("string").alias("string_value"),
        (F.lit(None) if strings is None else strings).cast("array<string>").alias("string_list_value"),
        (F.lit(None) if number is None else number).cast("double").alias("numeric_value"),
    )


def page_passages(
    pages: DataFrame, max_words: int = 200, merge: bool = True, excluded: frozenset[str] = EXCLUDED
) -> DataFrame:
    """Passages of each page's HTML: ``page_id, passage_no, passage``; no shuffle."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (page, i, text)
                for page, html in zip(frame["page_id"], frame["html"])
                if html is not None
                for i, text in enumerate(passages(html, max_words, merge, excluded))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "passage_no", "passage"])

    return pages.select("page_id", "html").mapInPandas(
        split, "page_id long, passage_no int, passage string"
    )


def with_chunk_metadata(chunks: DataFrame, tags: Column, strategy: str, publish_date: Column) -> DataFrame:
    return chunks.select(
        "*",
        F.create_map(
            F.lit("tags"), metadata(strings=tags),
            F.lit("chunking_strategy"), metadata(string=F.lit(strategy)),
            F.lit("publish_date"), metadata(number=publish_date),
        ).alias("custom_metadata"),
    )


def get_by_name(table: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of ``table`` whose full resource name is asked for."""
    return table.join(names.select("name").distinct(), "name", "left_semi")


def pages_of(children: DataFrame, parent: str, key: str, size: int = PAGE_DEFAULT) -> DataFrame:
    """List children of each parent in ascending ``key``: adds ``position`` and 0-based ``page``."""
    if not 1 <= size <= PAGE_MAX:
        raise ValueError(f"page size must be 1 to {PAGE_MAX}")
    return positions(children, [parent], key).withColumn(
        "page", F.floor(F.col("position") / F.lit(size)).cast("long")
    )


def next_page(children: DataFrame, key: str, token=None, size: int = PAGE_DEFAULT) -> DataFrame:
    """The page after ``token``, the last key of the page before."""
    if not 1 <= size <= PAGE_MAX:
        raise ValueError(f"page size must be 1 to {PAGE_MAX}")
    rest = children if token is None else children.where(F.col(key) > F.lit(token))
    return rest.orderBy(key).limit(size)


def next_pages(children: DataFrame, tokens: DataFrame, parent: str, key: str, size: int = PAGE_DEFAULT) -> DataFrame:
    """The page of each asked parent after its ``token``, the last key it has seen; null for the first page.

    Adds ``next_page_token``, null on the last page. A parent's rows after its token are cut to a page and one row
    inside each task before anything is shuffled.
    """
    if not 1 <= size <= PAGE_MAX:
        raise ValueError(f"page size must be 1 to {PAGE_MAX}")
    asked = tokens.select(F.col(parent).alias("__parent"), "token")
    rest = children.join(asked, F.col(parent) == F.col("__parent")).where(F.col("token").isNull() | (F.col(key) > F.col("token")))
    order = Window.partitionBy("__parent").orderBy(key)
    cut = rest.select("*", F.row_number().over(order).alias("__r")).where(F.col("__r") <= size + 1)
    more = F.max("__r").over(Window.partitionBy("__parent")) > size
    last = F.max(F.when(F.col("__r") == size, F.col(key))).over(Window.partitionBy("__parent"))
    return cut.select(*children.columns, F.when(more, last).alias("next_page_token"), "__r").where(F.col("__r") <= size).drop("__r")


def quota_violations(
    corpora: DataFrame | None = None,
    documents: DataFrame | None = None,
    chunks: DataFrame | None = None,
    quotas: dict[str, int] | None = None,
) -> DataFrame:
    """``rule, key, observed, quota`` for each limit exceeded.

    ``corpora(name, display_name)``, ``documents(name, corpus, display_name)`` and
    ``chunks(name, corpus, text)``; a ``custom_metadata`` column is checked where there is one.
    """
    quota = {**QUOTAS, **(quotas or {})}
    found = []

    def check(df: DataFrame, key: Column, **observed: Column) -> None:
        """All rules on the rows of ``df`` in one pass."""
        results = [
            F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("key"),
                     value.cast("long").alias("observed"), F.lit(quota[rule]).cast("long").alias("quota"))
            for rule, value in observed.items()
        ]
        found.append(df.select(F.inline(F.array(*results))).where(F.col("observed") > F.col("quota")))

    def metadata_rules(df: DataFrame) -> dict[str, Column]:
        if "custom_metadata" not in df.columns:
            return {}
        lists = F.transform(
            F.map_values("custom_metadata"), lambda m: F.coalesce(F.size(m["string_list_value"]), F.lit(0))
        )
        return {"metadata_keys": F.size("custom_metadata"), "list_values": F.array_max(lists)}

    def children(df: DataFrame) -> DataFrame:
        return df.groupBy("corpus").agg(F.count("*").alias("n"))

    name, last = F.col("name"), F.substring_index("name", "/", -1)
    if corpora is not None:
        check(corpora.agg(F.count("*").alias("n")), F.lit("all"), corpora=F.col("n"))
        check(corpora, name, name_chars=F.length(last), corpus_display_chars=F.length("display_name"))
    if documents is not None:
        check(children(documents), F.col("corpus"), documents_per_corpus=F.col("n"))
        check(documents, name, name_chars=F.length(last), document_display_chars=F.length("display_name"),
              **metadata_rules(documents))
    if chunks is not None:
        check(children(chunks), F.col("corpus"), chunks_per_corpus=F.col("n"))
        check(chunks, name, tokens_per_chunk=token_count(F.col("text")), **metadata_rules(chunks))
    return reduce(DataFrame.unionByName, found)


class FailedPrecondition(RuntimeError):
    """A corpus that still has documents was to be deleted without ``force``."""


def delete_corpora(
    names: DataFrame, corpora: DataFrame, documents: DataFrame, chunks: DataFrame, force: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left of corpora, documents and chunks after deleting the corpora in ``names``."""
    doomed = names.select(F.col("name").alias("corpus")).distinct()
    if not force and not documents.join(doomed, "corpus", "left_semi").isEmpty():
        raise FailedPrecondition("corpus is not empty; pass force=True to delete its documents too")
    left = corpora.join(doomed, corpora["name"] == doomed["corpus"], "left_anti")
    return left, documents.join(doomed, "corpus", "left_anti"), chunks.join(doomed, "corpus", "left_anti")
