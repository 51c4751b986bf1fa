"""Queries on pages and on the corpus, document and chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import token_count
from tidemill.operators import chunking, corpus
from tidemill.plans.registry import Tables, query

PIECE = 200

NAMES_SQL = """
    named AS (SELECT doc_id, source, lang, text,
        'corpora/' || source || '-' || substr(sha256(source), 1, 12) AS corpus,
        'documents/doc-' || doc_id || '-' || substr(sha256('doc ' || doc_id || '|' || text), 1, 12) AS doc
        FROM documents)"""


def corpora(t: Tables) -> DataFrame:
    sources = t.documents.select("source").distinct()
    return sources.select(
        corpus.resource_name("corpora", F.col("source")).alias("name"), F.col("source").alias("display_name")
    )


def documents(t: Tables) -> DataFrame:
    title = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    parent = corpus.resource_name("corpora", F.col("source"))
    docs = t.documents.select("doc_id", "source", "lang", "n_chars", "text")
    return docs.select(
        "doc_id",
        corpus.resource_name("documents", title, F.col("text"), parent=parent).alias("name"),
        parent.alias("corpus"),
        title.alias("display_name"),
        F.create_map(
            F.lit("language"), corpus.metadata(string=F.col("lang")),
            F.lit("n_chars"), corpus.metadata(number=F.col("n_chars")),
        ).alias("custom_metadata"),
        "text",
    )


def chunks(t: Tables, size: int = PIECE) -> DataFrame:
    """Names carry over from the document row, so chunking needs no join."""
    docs = documents(t).select(F.struct("doc_id", "name", "corpus").alias("doc"), "text")
    pieces = chunking.split_tokens(docs, size, key="doc")
    return pieces.select(
        "doc.doc_id", F.col("doc.name").alias("document"), "doc.corpus", "piece", "text",
        F.concat("doc.name", F.lit("/chunks/"), F.col("piece").cast("string")).alias("name"),
        F.lit("ACTIVE").alias("state"),
    )


@query(
    "pages_scan",
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
               regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, length(html) AS n_chars FROM pages""",
)
def _(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.length("html").cast("long").alias("n_chars"),
    )


@query("html_passages")
def _(t: Tables) -> DataFrame:
    passages = corpus.page_passages(t.pages.select("page_id", "html"), max_words=200, merge=True)
    tagged = corpus.with_chunk_metadata(
        passages, F.array(F.lit("page"), F.lit("crawl")), "greedily_aggregate_sibling_nodes", F.lit(20240101)
    )
    return tagged.select(
        "page_id", "passage_no", "passage",
        F.col("custom_metadata")["chunking_strategy"]["string_value"].alias("strategy"),
        F.array_join(F.col("custom_metadata")["tags"]["string_list_value"], ",").alias("tags"),
        F.col("custom_metadata")["publish_date"]["numeric_value"].alias("publish_date"),
    )


@query(
    "html_passage_words",
    r"""SELECT page_id, len(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(html,
            '<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->', ' ', 'gis'),
            '<[^>]*>|&nbsp;', ' ', 'g'), '\s+'), lambda w: w <> '')) AS n_words FROM pages""",
)
def _(t: Tables) -> DataFrame:
    """No passage loses or repeats a word of its page."""
    passages = corpus.page_passages(t.pages.select("page_id", "html"), max_words=200, merge=True)
    counts = passages.groupBy("page_id").agg(F.sum(token_count(F.col("passage"))).alias("n"))
    return t.pages.select("page_id").join(counts, "page_id", "left").select("page_id", F.coalesce("n", F.lit(0)).alias("n_words"))


@query("html_passages_flat")
def _(t: Tables) -> DataFrame:
    return corpus.page_passages(t.pages.select("page_id", "html"), max_words=100, merge=False)


@query("build_corpus", f"WITH {NAMES_SQL} SELECT doc_id, corpus, corpus || '/' || doc AS name FROM named")
def _(t: Tables) -> DataFrame:
    return documents(t).select("doc_id", "corpus", "name")


@query(
    "build_chunks",
    rf"""WITH {NAMES_SQL}, toks AS (SELECT corpus || '/' || doc AS document, regexp_extract_all(text, '\S+') AS ts FROM named)
        SELECT document || '/chunks/' || i AS name, array_to_string(ts[i * {PIECE} + 1 : (i + 1) * {PIECE}], ' ') AS text
        FROM (SELECT document, ts, unnest(range(0, (len(ts) + {PIECE} - 1) // {PIECE})) AS i FROM toks)""",
)
def _(t: Tables) -> DataFrame:
    return chunks(t).select("name", "text")


@query(
    "get_by_name",
    f"WITH {NAMES_SQL} SELECT corpus || '/' || doc AS name, doc_id, lang FROM named WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def _(t: Tables) -> DataFrame:
    docs = documents(t).select("doc_id", "name", F.col("custom_metadata")["language"]["string_value"].alias("lang"))
    asked = documents(t).join(t.labels, "doc_id", "left_semi").select("name")
    return corpus.get_by_name(docs, asked)


@query(
    "paginate",
    """SELECT source, doc_id, position, position // 10 AS page FROM (
           SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS position FROM documents)""",
)
def _(t: Tables) -> DataFrame:
    return corpus.pages_of(t.documents.select("source", "doc_id"), "source", "doc_id")


@query(
    "next_page",
    """WITH placed AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place,
                              count(*) OVER (PARTITION BY source) AS n FROM documents)
       SELECT p.source, p.doc_id, l.doc_id AS next_page_token
       FROM placed p LEFT JOIN placed l ON l.source = p.source AND l.place = 20 AND p.n > 20
       WHERE p.place BETWEEN 11 AND 20""",
)
def _(t: Tables) -> DataFrame:
    """The second page of each source, asked for with the token that came with the first."""
    children = t.documents.select("source", "doc_id")
    first = children.select("source").distinct().withColumn("token", F.lit(None).cast("long"))
    page = corpus.next_pages(children, first, "source", "doc_id")
    tokens = page.where("next_page_token IS NOT NULL").select("source", F.col("next_page_token").alias("token")).distinct()
    return corpus.next_pages(children, tokens, "source", "doc_id")


@query(
    "quota_violations",
    rf"""WITH {NAMES_SQL}, found AS (
            SELECT 'corpora' AS rule, 'all' AS key, count(DISTINCT source) AS observed, 5 AS quota FROM documents
            UNION ALL SELECT 'documents_per_corpus', corpus, count(*), 10000 FROM named GROUP BY corpus
            UNION ALL SELECT 'tokens_per_chunk', corpus || '/' || doc || '/chunks/0',
                             len(regexp_extract_all(text, '\S+')), 2043 FROM named)
        SELECT rule, key, observed, CAST(quota AS BIGINT) AS quota FROM found WHERE observed > quota""",
)
def _(t: Tables) -> DataFrame:
    docs = documents(t)
    whole = docs.select(F.concat("name", F.lit("/chunks/0")).alias("name"), "corpus", "text")
    return corpus.quota_violations(corpora(t), docs, whole)


@query(
    "cascade_delete",
    r"""WITH kept AS (SELECT * FROM documents WHERE source NOT LIKE 'src1%')
       SELECT 'corpora' AS kind, count(DISTINCT source) AS n FROM kept
       UNION ALL SELECT 'documents', count(*) FROM kept
       UNION ALL SELECT 'chunks', coalesce(sum((len(regexp_extract_all(text, '\S+')) + 199) // 200), 0)::BIGINT FROM kept""",
)
def _(t: Tables) -> DataFrame:
    all_corpora = corpora(t)
    doomed = all_corpora.where(F.col("display_name").startswith("src1")).select("name")
    left = corpus.delete_corpora(doomed, all_corpora, documents(t), chunks(t), force=True)
    counts = [df.agg(F.lit(k).alias("kind"), F.count("*").alias("n")) for k, df in zip(("corpora", "documents", "chunks"), left)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
