"""Text expressions. All are JVM column expressions over whole texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns, literals and character ranges of the cleaning rules.
EMAIL = r"[\w\.-]+@[\w\.-]+"
PARENTHESES = r"\([^()]*\)"
HEADER_LITERALS = ("From: ", "\nSubject: ")
CONTROL_ALL = r"[\x00-\x1f\x7f-\x9f]"
CONTROL_KEEPING_BREAKS = r"[\x00-\x08\x0b\x0e-\x1f\x7f-\x9f]"
PUNCTUATION = r"""[!-/:-@\[-`{-~]"""
ACTION_LINE = r"^Action: (\w+): (.*)$"
TOKEN = r"\S+"
NON_WORD = r"[^\p{L}\p{N}]+"


def remove_emails(text: Column, unicode: bool = False) -> Column:
    """Drop e-mail addresses; ``unicode`` lets ``\\w`` match letters beyond ASCII."""
    pattern = f"(?U){EMAIL}" if unicode else EMAIL
    # Most texts have no @: skip the scan, which tries every word as a possible start.
    return F.when(text.contains("@"), F.regexp_replace(text, pattern, "")).otherwise(text)


def remove_parentheses(text: Column) -> Column:
    """Drop innermost parentheses with their content."""
    return F.regexp_replace(text, PARENTHESES, "")


def remove_headers(text: Column) -> Column:
    for literal in HEADER_LITERALS:
        text = F.replace(text, F.lit(literal), F.lit(""))
    return text


def clean(text: Column, max_chars: int | None = None, unicode: bool = False) -> Column:
    """E-mails, parentheses and header words removed, in that order; cut only if asked to."""
    out = remove_headers(remove_parentheses(remove_emails(text, unicode)))
    return out if max_chars is None else F.substring(out, 1, max_chars)


def from_marker(text: Column, marker: str) -> Column:
    """The text from the first ``marker`` on; null when there is none."""
    at = F.instr(text, marker)
    return F.when(at > 0, F.substring(text, at, F.length(text)))


def blank_control(text: Column) -> Column:
    """Control characters become spaces."""
    return F.regexp_replace(text, CONTROL_ALL, " ")


def blank_control_and_punctuation(text: Column) -> Column:
    """Punctuation and control characters become spaces, except TAB, LF, FF and CR."""
    return F.regexp_replace(F.regexp_replace(text, CONTROL_KEEPING_BREAKS, " "), PUNCTUATION, " ")


def render(template: str, **values: Column | str) -> Column:
    """Fill ``{name}`` places of a template with columns or constants."""
    pieces: list[Column] = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            pieces.append(F.lit(piece))
        else:
            value = values[piece]
            pieces.append(F.lit(value) if isinstance(value, str) else value.cast("string"))
    return F.concat(*pieces)


def join_parts(summary: Column, parts: Column, closing: Column) -> Column:
    """One document from a summary, an ordered array of parts and a closing section."""
    body = F.transform(
        parts,
        lambda p: F.concat(
            F.lit("\n## "), p["sub_header"], F.lit("\n"), p["explanation"], F.lit("\n"), p["code"], F.lit("\n")
        ),
    )
    return F.concat(F.lit("# "), summary, F.lit("\n"), F.array_join(body, ""), F.lit("\n"), closing)


def without_first_word(text: Column) -> Column:
    return F.regexp_replace(text, r"^\S+\s+", "")


def without_quotes(text: Column) -> Column:
    return F.translate(text, "\"'", "")


def first_action(text: Column) -> Column:
    """(tool, argument) of the first ``Action: tool: argument`` line, null if there is none."""
    pattern = "(?dm)" + ACTION_LINE  # d: only LF ends a line
    return F.when(
        F.regexp_like(text, F.lit(pattern)),
        F.struct(
            F.regexp_extract(text, pattern, 1).alias("tool"),
            F.regexp_extract(text, pattern, 2).alias("argument"),
        ),
    )


def token_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens in order."""
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), NON_WORD), "")


def word_bucket(word: Column) -> Column:
    """Hash of a text in 0 … 2**20 - 1: the first five hex digits of its md5.

    Never null, else a join on it would hash every text a second time to filter nulls.
    """
    return F.coalesce(F.conv(F.substring(F.md5(word), 1, 5), 16, 10).cast("int"), F.lit(0))
