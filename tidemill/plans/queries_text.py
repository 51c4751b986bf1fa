"""Queries on documents, conversations and event JSON."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import jsonx, text as tx
from tidemill.functions.vector_math import dot, epoch_text
from tidemill.operators import chunking, embedding, learning, relational as rel, sampling, windows
from tidemill.plans.registry import Tables, as_double, query
from tidemill.schemas import REPLY_WITH_PARTS
from tidemill.sources.files import rescue_json

EMAIL_SQL = r"regexp_replace(text, '[\w\.-]+@[\w\.-]+', '', 'g')"
CLEAN_SQL = rf"replace(replace(regexp_replace({EMAIL_SQL}, '\([^()]*\)', '', 'g'), 'From: ', ''), chr(10) || 'Subject: ', '')"
TOKENS_SQL = r"len(regexp_extract_all(text, '\S+'))"
WORDS_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
PLACED_SQL = """placed AS (SELECT conv_id, turn, role, text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS position FROM conversations)"""
PAGED_SQL = PLACED_SQL + ", paged AS (SELECT *, position // 64 AS page FROM placed)"
SPEAKER_SQL = "CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'Human' WHEN 'assistant' THEN 'AI Assistant' ELSE role END"


def texts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


@query("clean_text", f"SELECT doc_id, {CLEAN_SQL} AS text FROM documents")
def _(t: Tables) -> DataFrame:
    return texts(t).select("doc_id", tx.clean(F.col("text")).alias("text"))


@query("truncate_text", f"SELECT doc_id, substr({CLEAN_SQL}, 1, 5000) AS text FROM documents")
def _(t: Tables) -> DataFrame:
    return texts(t).select("doc_id", tx.clean(F.col("text"), max_chars=5000).alias("text"))


@query(
    "slice_from_marker",
    """SELECT doc_id, CASE WHEN instr(text, '. ') > 0 THEN substr(text, instr(text, '. ')) END AS rest FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return texts(t).select("doc_id", tx.from_marker(F.col("text"), ". ").alias("rest"))


@query("text_length", "SELECT page_id, length(html) AS n_chars FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.length("html").cast("long").alias("n_chars"))


@query(
    "strip_control_old",
    r"SELECT conv_id, turn, regexp_replace(text, '[\x00-\x1f\x7f-\x{9f}]', ' ', 'g') AS text FROM conversations",
)
def _(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", tx.blank_control(F.col("text")).alias("text"))


@query(
    "strip_control_punct",
    r"""SELECT page_id, regexp_replace(regexp_replace(html, '[\x00-\x08\x0b\x0e-\x1f\x7f-\x{9f}]', ' ', 'g'),
                                       '[!-/:-@\[-`{-~]', ' ', 'g') AS html FROM pages""",
)
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", tx.blank_control_and_punctuation(F.col("html")).alias("html"))


@query(
    "render_prompt",
    """SELECT c_custkey, 'You advise buyers from ' || n_name || '. Write to ' || c_name || ' about ' || c_mktsegment
              || ' offers.' AS prompt FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t: Tables) -> DataFrame:
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    template = "You advise buyers from {country}. Write to {name} about {topic} offers."
    prompt = tx.render(template, country=F.col("n_name"), name=F.col("c_name"), topic=F.col("c_mktsegment"))
    return c.select("c_custkey", prompt.alias("prompt"))


def _reply_json(t: Tables) -> DataFrame:
    """Model replies with parts, made of each conversation page's messages."""
    message = F.struct(
        "turn", F.col("role").alias("sub_header"), F.col("text").alias("code"), F.lit("as said").alias("explanation")
    )
    parts = F.transform(
        F.sort_array(F.collect_list(message)), lambda p: F.struct(p["sub_header"], p["code"], p["explanation"])
    )
    paged = windows.paged(t.conversations).groupBy("conv_id", "page").agg(parts.alias("parts"))
    reply = F.struct(F.lit("Talk").alias("summary"), F.size("parts").alias("number_of_parts"), "parts")
    return paged.select("conv_id", "page", F.to_json(reply).alias("reply"))


@query(
    "assemble_parts",
    rf"""WITH {PAGED_SQL} SELECT conv_id, page, '# Talk' || chr(10) || string_agg(
            chr(10) || '## ' || role || chr(10) || 'as said' || chr(10) || text || chr(10), '' ORDER BY turn, role, text)
            || chr(10) || 'End' AS document
        FROM paged GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    reply = jsonx.parse_reply(F.col("reply"), REPLY_WITH_PARTS)
    parsed = _reply_json(t).select("conv_id", "page", reply.alias("r"))
    return parsed.select(
        "conv_id", "page", tx.join_parts(F.col("r.summary"), F.col("r.parts"), F.lit("End")).alias("document")
    )


@query("parse_reply_parts", "SELECT conv_id, role AS sub_header, text AS code FROM conversations")
def _(t: Tables) -> DataFrame:
    rows = jsonx.reply_rows(_reply_json(t), "reply", REPLY_WITH_PARTS, "parts")
    return rows.select("conv_id", "sub_header", "code")


@query(
    "normalise_text",
    r"""SELECT conv_id, turn, translate(regexp_replace(text, '^\S+\s+', ''), '"''', '') AS text FROM conversations""",
)
def _(t: Tables) -> DataFrame:
    normal = tx.without_quotes(tx.without_first_word(F.col("text")))
    return t.conversations.select("conv_id", "turn", normal.alias("text"))


@query(
    "extract_actions",
    r"""SELECT conv_id, turn, role AS tool, split_part(text, chr(10), 1) AS argument,
               role IN ('user', 'assistant') AS known
        FROM conversations""",
)
def _(t: Tables) -> DataFrame:
    reply = F.concat(
        F.lit("Thought: look it up\nAction: "), F.col("role"), F.lit(": "), F.col("text"),
        F.lit("\nAction: user: a later one\nPAUSE"),
    )
    found = t.conversations.select("conv_id", "turn", tx.first_action(reply).alias("a"))
    return found.select("conv_id", "turn", "a.*", F.col("a.tool").isin("user", "assistant").alias("known"))


@query(
    "json_fields",
    """SELECT c_custkey, c_name AS f_name, c_mktsegment AS l_name FROM customer""",
)
def _(t: Tables) -> DataFrame:
    profile = F.to_json(F.struct(F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), "c_acctbal"))
    people = t.customer.select("c_custkey", profile.alias("profile"))
    return people.select("c_custkey", *jsonx.fields(F.col("profile"), f_name="first_name", l_name="last_name"))


@query("parse_reply", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", jsonx.parse_reply(F.col("props"), "k int")["k"].alias("k"))


@query("parse_single_quote", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def _(t: Tables) -> DataFrame:
    quoted = F.translate("props", '"', "'")
    return t.events.select("event_id", jsonx.parse_reply(quoted, "k int")["k"].alias("k"))


def _tag_json(t: Tables) -> DataFrame:
    """Tag replies made of events; some miss a field or leave the allowed values."""
    tags = F.struct(
        F.when(F.col("event_type") == "click", "happy").when(F.col("event_type") == "view", "neutral")
        .when(F.col("event_type") == "error", "sad").otherwise(F.col("event_type")).alias("sentiment"),
        F.pmod(F.col("event_id"), F.lit(7)).cast("int").alias("aggressiveness"),
        F.when(F.col("user_id") > 3, "english").alias("language"),
    )
    return t.events.select("event_id", F.to_json(tags).alias("reply"))


@query(
    "validate_reply",
    """WITH r AS (SELECT event_id, event_id % 7 AS a, user_id > 3 AS has_language,
                         event_type IN ('click', 'view', 'error') AS good FROM events)
       SELECT event_id, concat_ws('; ', CASE WHEN NOT good THEN 'sentiment: not allowed' END,
                  CASE WHEN a NOT BETWEEN 1 AND 5 THEN 'aggressiveness: not allowed' END,
                  CASE WHEN NOT has_language THEN 'language: missing' END) AS errors,
              good AND a BETWEEN 1 AND 5 AND has_language AS valid FROM r""",
)
def _(t: Tables) -> DataFrame:
    checked = jsonx.validate(_tag_json(t), "reply", jsonx.TAGS)
    return checked.select("event_id", F.concat_ws("; ", "errors").alias("errors"), "valid")


@query("python_literal", "SELECT event_id, props->>'$.k' AS k, NULL::VARCHAR AS missing, event_id % 2 = 0 AS even FROM events")
def _(t: Tables) -> DataFrame:
    """Records as Python prints them: constants by name, tuples, quotes of either kind."""
    k = F.get_json_object("props", "$.k")
    literal = F.format_string(
        "{'k': '%s', 'note': \"None, it's (True)\", 'missing': None, 'even': %s, 'pair': (%d, 2,)}",
        k, F.when(F.col("event_id") % 2 == 0, "True").otherwise("False"), "event_id",
    )
    parsed = jsonx.parse_reply(jsonx.python_to_json(literal), "k string, note string, missing string, even boolean, pair array<long>")
    rows = t.events.select("event_id", parsed.alias("r"))
    intact = (F.col("r.note") == "None, it's (True)") & (F.col("r.pair")[0] == F.col("event_id"))
    return rows.where(intact).select("event_id", "r.k", "r.missing", "r.even")


@query(
    "rescue_json",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
              CASE WHEN event_type = 'error' THEN '{"value":"n/a","source":"' || event_type || '"}'
                   ELSE '{"source":"' || event_type || '"}' END AS _rescued_data
       FROM events""",
)
def _(t: Tables) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    raw = t.events.select(
        F.format_string('{"event_id": %d, "value": %s, "source": "%s"}', "event_id", value, "event_type").alias("line")
    )
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return rescue_json(raw, "line", schema)


@query(
    "epoch_format",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date FROM orders",
)
def _(t: Tables) -> DataFrame:
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return t.orders.select("o_orderkey", epoch_text(days.cast("long") * 86400).alias("order_date"))


@query("token_count", rf"SELECT doc_id, {TOKENS_SQL} AS n_tokens FROM documents")
def _(t: Tables) -> DataFrame:
    return texts(t).select("doc_id", tx.token_count(F.col("text")).alias("n_tokens"))


@query(
    "chat_history",
    f"""WITH {PLACED_SQL}, last AS (SELECT conv_id, max(turn) AS asked_turn FROM conversations GROUP BY 1)
        SELECT conv_id, asked_turn, position, role, text FROM placed JOIN last USING (conv_id)""",
)
def _(t: Tables) -> DataFrame:
    return windows.chat_history(t.conversations, windows.last_turns(t.conversations))


@query(
    "history_length",
    """SELECT DISTINCT conv_id, turn, count(*) OVER (PARTITION BY conv_id ORDER BY turn) AS n_messages FROM conversations""",
)
def _(t: Tables) -> DataFrame:
    return windows.history_length(t.conversations)


@query(
    "running_prompt_tokens",
    rf"""SELECT conv_id, turn, CAST(size AS BIGINT) AS size, CAST(sum(size) OVER (
             PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS running_size
         FROM (SELECT conv_id, turn, sum({TOKENS_SQL}) AS size FROM conversations GROUP BY 1, 2)""",
)
def _(t: Tables) -> DataFrame:
    return windows.running_size(t.conversations, tx.token_count(F.col("text")))


@query(
    "token_usage",
    rf"""SELECT conv_id, CAST(sum(CASE WHEN role <> 'assistant' THEN n ELSE 0 END) AS BIGINT) AS prompt_tokens,
                CAST(sum(CASE WHEN role = 'assistant' THEN n ELSE 0 END) AS BIGINT) AS completion_tokens,
                CAST(sum(n) AS BIGINT) AS total_tokens
         FROM (SELECT conv_id, role, {TOKENS_SQL} AS n FROM conversations) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return windows.usage_totals(t.conversations, tx.token_count(F.col("text")))


@query(
    "cap_turns",
    """SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn
       FROM conversations) WHERE rn <= 5""",
)
def _(t: Tables) -> DataFrame:
    return windows.cap_turns(t.conversations, 5).select("conv_id", "turn", "role")


@query(
    "render_transcript",
    f"""WITH {PAGED_SQL} SELECT conv_id, page, count(*) AS n_messages,
               string_agg({SPEAKER_SQL} || ': ' || text, chr(10) ORDER BY turn, role, text) AS transcript
        FROM paged GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return windows.transcript_pages(t.conversations)


@query(
    "history_json",
    "WITH " + PAGED_SQL + """ SELECT conv_id, page,
              to_json(list({'role': role, 'content': text} ORDER BY turn, role, text))::VARCHAR AS messages
       FROM paged GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    return windows.history_json(t.conversations)


PIECES_SQL = r"""
    SELECT doc_id, CAST(piece AS INTEGER) AS piece, toks[piece * {size} + 1 : (piece + 1) * {size}] AS toks
    FROM (SELECT doc_id, toks, unnest(range(0, (len(toks) + {size} - 1) // {size})) AS piece
          FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS toks FROM documents))"""


@query(
    "split_tokens",
    f"""SELECT doc_id, piece, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS text
        FROM ({PIECES_SQL.format(size=1000)})""",
)
def _(t: Tables) -> DataFrame:
    return chunking.split_tokens(texts(t), 1000)


@query(
    "batch_chunks",
    f"""SELECT doc_id, piece, CAST(piece // 100 AS INTEGER) AS batch FROM ({PIECES_SQL.format(size=20)})""",
)
def _(t: Tables) -> DataFrame:
    pieces = chunking.split_tokens(texts(t), 20)
    return pieces.select("doc_id", "piece", F.floor(F.col("piece") / F.lit(100)).cast("int").alias("batch"))


@query("stuff_docs", r"SELECT doc_id, array_to_string(regexp_extract_all(text, '\S+'), ' ') AS text FROM documents")
def _(t: Tables) -> DataFrame:
    return texts(t).select("doc_id", chunking.stuff(F.col("text")).alias("text"))


@query(
    "pack_chunks",
    # Pieces of 300 tokens in groups of 4000: 13 full pieces a group, the last piece may be smaller.
    rf"""SELECT doc_id, piece, CAST(CASE WHEN piece % 13 = 0 AND piece > 0 AND n - piece * 300 <= 100
                    THEN piece // 13 - 1 ELSE piece // 13 END AS INTEGER) AS grp
         FROM (SELECT doc_id, n, CAST(unnest(range(0, (n + 299) // 300)) AS INTEGER) AS piece
               FROM (SELECT doc_id, {TOKENS_SQL} AS n FROM documents))""",
)
def _(t: Tables) -> DataFrame:
    return chunking.packed_pieces(texts(t), 300, 4000)


BUCKET_SQL = "('0x' || substr(md5(w), 1, 5))::INTEGER"
THEMES_SQL = rf"""
    words AS (SELECT doc_id, w, CAST((pos - 1) // 1000 AS INTEGER) AS piece FROM (
        SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
        FROM (SELECT doc_id, {WORDS_SQL} AS ws FROM documents))),
    uses AS (SELECT bucket, count(*) AS uses FROM (SELECT DISTINCT doc_id, w, {BUCKET_SQL} AS bucket FROM words) GROUP BY 1),
    tf AS (SELECT doc_id, piece, w, count(*) AS tf, {BUCKET_SQL} AS bucket FROM words GROUP BY 1, 2, 3),
    scored AS (SELECT doc_id, piece, w,
                      CAST(tf * ln((SELECT count(*) + 1 FROM documents) / (uses + 1)) AS DECIMAL(18,6)) AS score
               FROM tf JOIN uses USING (bucket)),
    themes AS (SELECT doc_id, piece, w, score FROM (SELECT *, row_number() OVER (
        PARTITION BY doc_id, piece ORDER BY score DESC, w) AS rn FROM scored) WHERE rn <= 5)"""


@query("piece_themes", f"WITH {THEMES_SQL} SELECT doc_id, piece, w AS word, CAST(score AS DOUBLE) AS score FROM themes")
def _(t: Tables) -> DataFrame:
    return as_double(chunking.piece_themes(t.documents), "score")


@query(
    "theme_summary",
    f"""WITH {THEMES_SQL} SELECT doc_id, word, CAST(score AS DOUBLE) AS score, n_pieces, rank FROM (
            SELECT doc_id, w AS word, sum(score) AS score, count(*) AS n_pieces, CAST(row_number() OVER (
                PARTITION BY doc_id ORDER BY sum(score) DESC, w) AS INTEGER) AS rank
            FROM themes GROUP BY 1, 2) WHERE rank <= 10""",
)
def _(t: Tables) -> DataFrame:
    return as_double(chunking.theme_summary(chunking.piece_themes(t.documents)), "score")


@query(
    "refine_summary",
    f"""WITH {THEMES_SQL},
        steps AS (SELECT DISTINCT doc_id, piece FROM themes)
        SELECT doc_id, s.piece, string_agg(DISTINCT w, ' ' ORDER BY w) AS summary
        FROM steps s JOIN themes t USING (doc_id) WHERE t.piece <= s.piece GROUP BY 1, 2""",
)
def _(t: Tables) -> DataFrame:
    steps = chunking.refine_summary(chunking.piece_themes(t.documents))
    return steps.select("doc_id", "piece", F.array_join(F.sort_array("summary"), " ").alias("summary"))


def _count_sql(words: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words.split())
    return f"len(list_filter(ws, lambda w: list_contains([{listed}], w)))"


LANGUAGE_SQL = f"""
    SELECT doc_id, lang, CASE
        WHEN english >= greatest(french, german, italian, spanish) THEN 'english'
        WHEN french >= greatest(german, italian, spanish) THEN 'french'
        WHEN german >= greatest(italian, spanish) THEN 'german'
        WHEN italian >= spanish THEN 'italian' ELSE 'spanish' END AS detected
    FROM (SELECT doc_id, lang, {", ".join(f"{_count_sql(v)} AS {k}" for k, v in chunking.STOP_WORDS.items())}
          FROM (SELECT doc_id, lang, {WORDS_SQL} AS ws FROM documents))"""
# The given language codes.
CODES = {"de": "german", "en": "english", "es": "spanish", "fr": "french", "it": "italian"}
NAMED_SQL = "CASE lang " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in CODES.items()) + " END"


def _detected(t: Tables) -> DataFrame:
    named: Column = F.col("lang")
    for code, name in CODES.items():
        named = F.when(F.col("lang") == code, F.lit(name)).otherwise(named)
    docs = t.documents.select("doc_id", "lang", "text")
    return chunking.with_language(docs, out="detected").select("doc_id", named.alias("actual"), "detected")


@query("detect_language", f"SELECT doc_id, {NAMED_SQL} AS actual, detected FROM ({LANGUAGE_SQL})")
def _(t: Tables) -> DataFrame:
    return _detected(t)


@query(
    "class_accuracy",
    f"""SELECT actual, count(*) AS n, CAST(sum(CASE WHEN actual = detected THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
               round(avg(CASE WHEN actual = detected THEN 1 ELSE 0 END), 6) AS accuracy
        FROM (SELECT {NAMED_SQL} AS actual, detected FROM ({LANGUAGE_SQL})) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    scored = rel.accuracy_by_class(_detected(t), "actual", "detected")
    return scored.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "confusion_matrix",
    f"""SELECT actual, {", ".join(f"count(*) FILTER (detected = '{n}') AS predicted_{n}" for n in sorted(CODES.values()))},
               count(*) FILTER (detected IS NULL OR detected NOT IN ({", ".join(f"'{n}'" for n in sorted(CODES.values()))})) AS predicted_other
        FROM (SELECT {NAMED_SQL} AS actual, detected FROM ({LANGUAGE_SQL})) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return rel.confusion_matrix(_detected(t), "actual", "detected", sorted(CODES.values()))


def _tags_sql(themes: str, given: str) -> str:
    return f"""WITH {themes},
        tagged AS (SELECT doc_id, len(ws) AS n, {_count_sql(chunking.POSITIVE)} AS pos, {_count_sql(chunking.NEGATIVE)} AS neg,
                          {_count_sql(chunking.AGGRESSIVE)} AS agg
                   FROM (SELECT doc_id, {WORDS_SQL} AS ws FROM {given}))
        SELECT g.doc_id, url, CASE WHEN pos > neg THEN 'happy' WHEN pos < neg THEN 'sad' ELSE 'neutral' END AS sentiment,
               CAST(least(1 + agg * 100 // greatest(n, 1), 5) AS INTEGER) AS aggressiveness, w AS primary_topic,
               CASE WHEN w IS NULL THEN 'primary_topic: missing' ELSE '' END AS errors, w IS NOT NULL AS valid
        FROM tagged g LEFT JOIN (SELECT doc_id, w FROM (SELECT *, row_number() OVER (
            PARTITION BY doc_id ORDER BY score DESC, w) AS rn FROM scored) WHERE rn = 1) USING (doc_id)
            LEFT JOIN pages ON page_id = doc_id"""


def _tagged(docs: DataFrame) -> DataFrame:
    tagged = chunking.tag_with_topic(docs, "doc_id", "text", "url")
    return tagged.withColumn("errors", F.array_join("errors", "; "))


@query("tag_documents", _tags_sql(THEMES_SQL.replace("// 1000", "// 1000000000"), "documents"))
def _(t: Tables) -> DataFrame:
    """A document's address is that of the page with its number."""
    urls = t.pages.select(F.col("page_id").alias("doc_id"), "url")
    tagged = chunking.tag_with_topic(t.documents.select("doc_id", "text"))
    return tagged.join(urls, "doc_id", "left").withColumn("errors", F.array_join("errors", "; "))


PAGE_TEXT_SQL = r"""(SELECT page_id AS doc_id, regexp_replace(regexp_replace(html,
    '<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'g') AS text FROM pages)"""


@query("tag_pages", _tags_sql(THEMES_SQL.replace("// 1000", "// 1000000000").replace("documents", PAGE_TEXT_SQL), PAGE_TEXT_SQL))
def _(t: Tables) -> DataFrame:
    """Web pages with their address, read as documents and tagged."""
    return _tagged(t.pages.select(F.col("page_id").alias("doc_id"), "url", chunking.page_text(F.col("html")).alias("text")))


# A bucket has 18 of the 20 bits of a word's hash; sign i of a bucket is bit i of md5 of "bucket:block".
def _bags_sql(key: str, given: str) -> str:
    words = f"SELECT {key}, unnest({WORDS_SQL}) AS w FROM ({given})"
    return f"(SELECT {key}, b, count(*) AS tf FROM (SELECT {key}, {BUCKET_SQL} // 4 AS b FROM ({words})) GROUP BY {key}, b)"


def _vectors_sql(key: str, texts: str, given: str, name: str) -> str:
    """SQL that defines ``<name>(key, i, x)``: unit vectors of ``texts``, with the weights of all of ``given``."""
    return f"""
    {name}_idf AS (SELECT b, ln((SELECT count(*) + 1 FROM ({given})) / (count(*) + 1)) AS idf FROM {_bags_sql(key, given)} GROUP BY b),
    {name}_bag AS (SELECT {key}, b, tf * idf AS w FROM {_bags_sql(key, texts)} JOIN {name}_idf USING (b)),
    {name}_bits AS (SELECT b, unnest(range(6)) AS block FROM (SELECT DISTINCT b FROM {name}_bag)),
    {name}_hex AS (SELECT b, block * 128 + (p - 1) * 4 AS first_bit, ('0x' || substr(md5(b || ':' || block), p::INTEGER, 1))::INTEGER AS digit
                   FROM (SELECT b, block, unnest(range(1, 33)) AS p FROM {name}_bits)),
    {name}_sign AS (SELECT b, first_bit + k AS i, 2 * ((digit >> (3 - k)::INTEGER) & 1) - 1 AS s FROM (SELECT b, first_bit, digit, unnest(range(4)) AS k FROM {name}_hex)),
    {name}_sum AS (SELECT {key}, i, sum(w * s) AS x FROM {name}_bag JOIN {name}_sign USING (b) GROUP BY ALL),
    {name} AS (SELECT {key}, i, x / sqrt(nullif(sum(x * x) OVER (PARTITION BY {key}), 0)) AS x FROM {name}_sum)"""


DOCS_SQL = "SELECT doc_id, text FROM documents"


@query(
    "embed_text",
    f"""WITH {_vectors_sql("doc_id", DOCS_SQL, DOCS_SQL, "v")}
        SELECT doc_id, lang, round(max(x), 6) AS peak, round(sum(x * (i + 1)) / 768, 6) AS digest, CAST(count(x) AS INTEGER) AS dim
        FROM documents LEFT JOIN v USING (doc_id) GROUP BY doc_id, lang""",
)
def _(t: Tables) -> DataFrame:
    """Vectors of 768 elements, told by their size, largest element, and a sum that weighs elements by their place."""
    vectors = embedding.fit_embedder(t.documents.select("text")).embed(embedding.spread(t.documents.select("doc_id", "lang", "text")), "doc_id", "lang")
    place = F.aggregate(F.transform("vector", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x) / embedding.DIMS
    return vectors.select(
        "doc_id", "lang", F.round(F.array_max("vector"), 6).alias("peak"), F.round(place, 6).alias("digest"),
        F.coalesce(F.size("vector"), F.lit(0)).alias("dim"),
    )


MESSAGES_SQL = "SELECT conv_id, turn, text FROM conversations"
NORMAL_SQL = r"""SELECT conv_id, turn, translate(regexp_replace(text, '^\S+\s+', ''), '"' || chr(39), '') AS text FROM conversations"""


@query(
    "text_similarity",
    f"""WITH {_vectors_sql("conv_id, turn", MESSAGES_SQL, MESSAGES_SQL, "a")}, {_vectors_sql("conv_id, turn", NORMAL_SQL, MESSAGES_SQL, "b")}
        SELECT conv_id, turn, round(sum(a.x * b.x), 6) AS similarity
        FROM conversations LEFT JOIN a USING (conv_id, turn) LEFT JOIN b USING (conv_id, turn, i) GROUP BY conv_id, turn""",
)
def _(t: Tables) -> DataFrame:
    """How far dropping the first word and the quotes moves a message's vector."""
    messages = t.conversations.select("conv_id", "turn", "text")
    embedder = embedding.fit_embedder(messages)
    normal = tx.without_quotes(tx.without_first_word(F.col("text"))).alias("normal")
    before = embedder.embed(embedding.spread(messages).select("*", normal), "conv_id", "turn", "normal", out="before")
    both = embedder.embed(before, "conv_id", "turn", "before", text="normal", out="after")
    return both.select("conv_id", "turn", F.round(dot(F.col("before"), F.col("after")), 6).alias("similarity"))


SIMILAR = 0.95


@query(
    "similar_pairs",
    f"""WITH {_vectors_sql("doc_id", DOCS_SQL, DOCS_SQL, "v")},
        named AS (SELECT doc_id, string_agg(b || ':' || tf, ',' ORDER BY b) AS same FROM {_bags_sql("doc_id", DOCS_SQL)} GROUP BY doc_id),
        classes AS (SELECT min(doc_id) AS id, count(*) AS size FROM named GROUP BY same),
        packed AS (SELECT id, size, list(x ORDER BY i) AS v FROM classes JOIN v ON doc_id = id GROUP BY id, size),
        pairs AS (SELECT a.id AS left_id, b.id AS right_id, list_inner_product(a.v, b.v) AS similarity, a.size AS left_size, b.size AS right_size
                  FROM packed a JOIN packed b ON a.id < b.id)
        SELECT left_id, right_id, round(similarity, 6) AS similarity, left_size, right_size FROM pairs WHERE similarity >= {SIMILAR}""",
)
def _(t: Tables) -> DataFrame:
    """Documents alike in their words: pairs of classes, found in hash tables of their vectors' signs."""
    docs = embedding.spread(texts(t)).select("doc_id", embedding.bag_arrays(F.col("text")).alias("bag"))
    docs = embedding.written(docs.select("doc_id", "bag", embedding.same_words(F.col("bag"), bagged=True).alias("same")), "bags")
    embedder = embedding.fit_embedder(docs, "bag")
    vectors = embedder.embed(docs, "doc_id", "same", text="bag")
    source = embedding.packed(docs.select("doc_id", "same", "bag"))
    found = embedding.similar_pairs(vectors, SIMILAR, source=source, made=embedder.of_bags(t.documents.sparkSession))
    return found.withColumn("similarity", F.round("similarity", 6))


QUALITY_SAMPLE = 10_000


def _quality_model(t: Tables):
    """Word features, and a model of at most ``QUALITY_SAMPLE`` labelled rows of the training part, those with the smallest hashes."""
    features = learning.text_features(t.documents.select("text"), dims=1024)
    known = sampling.with_part(t.labels.select("doc_id", "quality"), "doc_id").where("part = 'train'").drop("part")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(QUALITY_SAMPLE)
    train = learning.embed_text(features, t.documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "quality")
    return features, learning.train_logistic(train, "features", "quality", max_iter=20)


@query("classify_quality")
def _(t: Tables) -> DataFrame:
    """Every document's label as a reply."""
    features, model = _quality_model(t)
    label = F.when(F.col("prediction") == 1, "positive").otherwise("negative")
    scored = model.transform(learning.embed_text(features, texts(t), "doc_id"))
    return scored.select("doc_id", F.to_json(F.struct(label.alias("sentiment"))).alias("reply"))


@query("evaluate_quality")
def _(t: Tables) -> DataFrame:
    """Loss, accuracy and calibration of the labels, over all labelled rows that were held out."""
    features, model = _quality_model(t)
    held_out = sampling.with_part(t.labels.select("doc_id", "quality"), "doc_id").where("part = 'test'").drop("part")
    rows = learning.embed_text(features, texts(t).join(held_out, "doc_id"), "doc_id", "quality")
    chances = vector_to_array("probability")
    scored = model.transform(rows).select(
        "quality", F.col("prediction").cast("int").alias("predicted"), F.array_max(chances).alias("confidence"),
        F.get(chances, F.col("quality").cast("int")).alias("chance"),
    )
    found = learning.evaluate_rows(scored, "quality")
    return found.select("bin", "n", *[F.round(c, 6).alias(c) for c in ("loss", "accuracy", "confidence")])
