"""JSON text: fields, model replies, validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fields(json: Column, **paths: str) -> list[Column]:
    """Named top-level string fields; one parse for all of them."""
    schema = ", ".join(f"`{p}` string" for p in dict.fromkeys(paths.values()))
    parsed = F.from_json(json, schema)
    return [parsed[p].alias(name) for name, p in paths.items()]


# Python's names of JSON's constants.
PYTHON_NAMES = {"None": "null", "True": "true", "False": "false"}


def python_to_json(literal: Column) -> Column:
    """A Python literal of dicts, lists, tuples, strings, numbers and constants as JSON.

    Only what is outside of strings is rewritten: constants by name, tuples as arrays. Strings keep
    their quotes, which :func:`parse_reply` reads.
    """
    # Possessive, so that long strings need no backtracking.
    string = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
    inside = F.regexp_extract_all(literal, F.lit(f"({string})"), F.lit(0))
    outside = F.split(literal, string, -1)

    def plain(code: Column) -> Column:
        for name, constant in PYTHON_NAMES.items():
            code = F.regexp_replace(code, rf"\b{name}\b", constant)
        # A trailing comma ends a tuple of one and may end the others.
        return F.regexp_replace(F.translate(code, "()", "[]"), r",(\s*[\]}])", "$1")

    parts = F.transform(outside, plain)
    woven = F.zip_with(F.slice(parts, F.lit(1), F.size(inside)), inside, lambda a, b: F.concat(a, b))
    return F.concat(F.array_join(woven, ""), F.element_at(parts, -1))


def parse_reply(json: Column, schema: str) -> Column:
    """A model's JSON reply; tolerates single quotes and raw line breaks inside strings."""
    return F.from_json(json, schema, {"allowUnquotedControlChars": "true", "allowSingleQuotes": "true"})


def reply_rows(df: DataFrame, json: str, schema: str, array: str) -> DataFrame:
    """One row per element of the reply's array field ``array``; an empty or unreadable reply has none."""
    others = [c for c in df.columns if c != json]
    return df.select(*others, parse_reply(F.col(json), schema)[array].alias("__a")).select(
        *others, F.inline("__a")
    )


@dataclass(frozen=True)
class Rule:
    """A required field of a reply, its type, and the values it may take (any if empty)."""

    name: str
    kind: str
    allowed: Sequence = ()


# Fields and values of the two tag schemas.
TAGS = (
    Rule("sentiment", "string", ("happy", "neutral", "sad")),
    Rule("aggressiveness", "int", (1, 2, 3, 4, 5)),
    Rule("language", "string", ("spanish", "english", "french", "german", "italian")),
)
DOCUMENT_TAGS = (
    Rule("sentiment", "string"),
    Rule("aggressiveness", "int"),
    Rule("primary_topic", "string"),
)


def validate(df: DataFrame, json: str, rules: Sequence[Rule]) -> DataFrame:
    """Parse ``json`` by ``rules``; adds the fields, ``errors`` and ``valid``.

    A field is ``missing`` when absent or of another type, ``not allowed`` when outside its values.
    """
    parsed = parse_reply(F.col(json), ", ".join(f"{r.name} {r.kind}" for r in rules))
    typed = df.select("*", parsed.alias("__p"))
    problems = []
    for r in rules:
        value = F.col(f"__p.{r.name}")
        problem = F.when(value.isNull(), F.lit(f"{r.name}: missing"))
        if r.allowed:
            problem = problem.when(~value.isin(list(r.allowed)), F.lit(f"{r.name}: not allowed"))
        problems.append(problem)
    return (
        typed.withColumn("errors", F.array_compact(F.array(*problems)))
        .select(
            *df.columns,
            *[F.col(f"__p.{r.name}").alias(r.name) for r in rules],
            "errors",
            (F.size("errors") == 0).alias("valid"),
        )
    )


def quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    return validated.where("valid"), validated.where("NOT valid")
