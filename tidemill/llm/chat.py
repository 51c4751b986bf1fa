"""Chat formatting that is proved by reading it back.

A turn is rendered as ``### Role: text</turn>`` and a newline. A rendered turn is parsed at once with
the same deterministic parser that readers use; where the parser does not give back the turn, the
control strings in the text are escaped, and the turn is parsed again. Escaping makes ``k``
backslashes before a control string ``2k + 1``, and ``k`` at the end of a text ``2k``; other
backslashes stay. So texts without control strings stay as they are.

Defined cases: a null text is an empty one; a null role, or one that is not lower-case a-z, has a
mark of its own and comes back as it was; turns are ordered by turn (nulls first), then role, then
text, so repeated rows are repeated turns; rows with a null conversation form one conversation; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Rows, table

# The template.
END = "</turn>"
MARK = r"[A-Z][a-z]*|=[0-9a-f]*|-"
HEADER = re.compile(rf"### ({MARK}): ")
CONTROL = re.compile(rf"(?<!\\)(\\*+)({END}|### (?:{MARK}):)")
LAST_SLASHES = re.compile(r"(?<!\\)\\+\Z")
TRAINED = "assistant"


class Broken(ValueError):
    """A text that is not the rendering of turns."""


def role_mark(role: str | None) -> str:
    if role is None:
        return "-"
    return role[0].upper() + role[1:] if re.fullmatch("[a-z]+", role) else "=" + role.encode().hex()


def role_of(mark: str) -> str | None:
    if mark == "-":
        return None
    return bytes.fromhex(mark[1:]).decode() if mark[0] == "=" else mark.lower()


def escape(text: str) -> str:
    text = CONTROL.sub(lambda m: m[1] * 2 + "\\" + m[2], text)
    return LAST_SLASHES.sub(lambda m: m[0] * 2, text)


def unescape(body: str) -> str:
    body = CONTROL.sub(lambda m: "\\" * (len(m[1]) // 2) + m[2], body)
    return LAST_SLASHES.sub(lambda m: "\\" * (len(m[0]) // 2), body)


def parse(text: str) -> list[tuple[str | None, str, int, int]]:
    """The turns of a rendered text: role, text, and where its escaped text starts and ends."""
    turns, at = [], 0
    while at < len(text):
        header = HEADER.match(text, at)
        if not header:
            raise Broken(f"no turn at {at}")
        start = header.end()
        for control in CONTROL.finditer(text, start):
            if len(control[1]) % 2 == 0:
                break
        else:
            raise Broken(f"the turn at {at} does not end")
        if control[2] != END:
            raise Broken(f"a turn starts inside the one at {at}")
        stop = control.start(2)
        if text[control.end(): control.end() + 1] != "\n":
            raise Broken(f"no new line after the turn at {at}")
        try:
            turns.append((role_of(header[1]), unescape(text[start:stop]), start, stop))
        except ValueError as wrong:
            raise Broken(f"no role at {at}") from wrong
        at = control.end() + 1
    return turns


def render_turn(role: str | None, text: str) -> str:
    """One turn, escaped only if it is not read back as it is."""
    head = f"### {role_mark(role)}: "
    for body in (text, escape(text)):
        rendered = f"{head}{body}{END}\n"
        try:
            if [t[:2] for t in parse(rendered)] == [(role, text)]:
                return rendered
        except Broken:
            pass
    raise AssertionError("an escaped turn was not read back")


PAGES = pa.schema([
    ("conv_id", pa.int64()), ("page", pa.int64()), ("text", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
])
PAGES_DDL = "conv_id long, page long, text string, loss array<struct<start:long,stop:long>>"


def format_conversations(turns: DataFrame, page_chars: int = 1 << 20) -> DataFrame:
    """Rendered conversations: ``conv_id, page, text, loss``.

    A page holds whole turns, and more than one turn only up to ``page_chars``; the pages of a
    conversation in order are the whole of it, and nearly every conversation is one page. ``loss``
    are the code points of the page that are trained on: the escaped texts of the assistant. Rows
    of a conversation come out together and in order, and no task holds more than a page of them.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(PAGES, 64)
        open_conv, page, parts, chars, loss = None, 0, [], 0, []
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                rendered = render_turn(role, text)
                other = (conv,) != open_conv
                if parts and (other or chars + len(rendered) > page_chars):
                    out.add(open_conv[0], page, "".join(parts), loss)
                    yield from out.full()
                    page, parts, chars, loss = page + 1, [], 0, []
                if other:
                    open_conv, page = (conv,), 0
                if role == TRAINED:
                    head = len(role_mark(role)) + 6
                    loss.append({"start": chars + head, "stop": chars + len(rendered) - len(END) - 1})
                parts.append(rendered)
                chars += len(rendered)
        if parts:
            out.add(open_conv[0], page, "".join(parts), loss)
        yield out.take()

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(render, PAGES_DDL)


DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
DIGESTS_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rendered conversations hold, found by parsing them: one row per conversation.

    A digest over a whole conversation is one sequence by its nature; it is fed page by page, so a
    task needs a page of memory however long the conversation is. ``formatted`` must be in the order
    of :func:`format_conversations`.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(DIGESTS)
        open_conv, n, turns, loss_chars, loss, chars = None, 0, None, 0, None, 0
        for batch in batches:
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv,) != open_conv:
                    if open_conv:
                        out.add(open_conv[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
                        yield from out.full()
                    open_conv, n, turns, loss_chars, loss, chars = (conv,), 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                for role, said, _, _ in parse(text):
                    turns.update(f"{role or ''}\n{said}\n".encode())
                    n += 1
                for span in spans:
                    trained = unescape(text[span["start"]: span["stop"]])
                    loss.update(trained.encode())
                    loss_chars += len(trained)
                chars += len(text)
        if open_conv:
            out.add(open_conv[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
        yield out.take()

    return formatted.select("conv_id", "text", "loss").mapInArrow(digest, DIGESTS_DDL)


# A conversation whose texts hold the template's own strings.
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.unionByName(probe)))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, regexp_replace(regexp_replace(text, '(\\*)(</turn>|### (?:[A-Z][a-z]*|=[0-9a-f]*|-):)', '\1\1\\\2', 'g'),
    '(\\+)$', '\1\1') AS body
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(body) + 14)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
