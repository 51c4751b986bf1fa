import json
import re

import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions import jsonx, text as tx
from tidemill.functions.vector_math import epoch_text


def apply(spark, f, *values):
    df = spark.createDataFrame(list(enumerate(values)), "i long, t string")
    return [r.out for r in df.select("i", f(F.col("t")).alias("out")).orderBy("i").collect()]


def python_clean(d):
    d = re.sub(r"[\w\.-]+@[\w\.-]+", "", d)
    d = re.sub(r"\([^()]*\)", "", d)
    return d.replace("From: ", "").replace("\nSubject: ", "")


TEXTS = [
    "From: a.b@c.org (Ann (x) Lee)\nSubject: hi", "josé@café.fr x", "plain", "", "((a)b)", "a@b@c", "From: \nSubject: ",
]


def test_clean_like_python(spark):
    assert apply(spark, lambda t: tx.clean(t, unicode=True), *TEXTS) == [python_clean(t) for t in TEXTS]


def test_cut_is_at_characters(spark):
    got = apply(spark, lambda t: tx.clean(t, max_chars=5000), "x" * 5000, "é" * 5001, "")
    assert [len(g) for g in got] == [5000, 5000, 0]


def test_marker(spark):
    assert apply(spark, lambda t: tx.from_marker(t, "Lines"), "a Lines: 3 Lines", "none") == ["Lines: 3 Lines", None]


def test_control_characters(spark):
    every = "".join(map(chr, range(0xA1)))
    old, new = apply(spark, tx.blank_control, every)[0], apply(spark, tx.blank_control_and_punctuation, every)[0]
    assert old == "".join(" " if i < 0x20 or 0x7F <= i < 0xA0 else chr(i) for i in range(0xA1))
    gone = {*range(0x09), 0x0B, *range(0x0E, 0x20), *range(0x7F, 0xA0)} | {ord(c) for c in r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""}
    assert new == "".join(" " if i in gone else chr(i) for i in range(0xA1))


def test_render(spark):
    assert apply(spark, lambda t: tx.render("{who} in {town}: {who}{{}}", who=t, town="Rome"), "Ann") == ["Ann in Rome: Ann{{}}"]
    with pytest.raises(KeyError):
        tx.render("{missing}")


def test_first_action(spark):
    got = apply(
        spark, tx.first_action,
        "Thought: x\nAction: lookup: Paris: France\nAction: sum: 1\nPAUSE", "no action", " Action: late: x", "Action: a: ",
    )
    assert [g and tuple(g) for g in got] == [("lookup", "Paris: France"), None, None, ("a", "")]


def test_normalise(spark):
    assert apply(spark, tx.without_first_word, 'SELECT "a" FROM t', "one") == ['"a" FROM t', "one"]
    assert apply(spark, tx.without_quotes, "\"a\" 'b'") == ["a b"]


def test_tokens(spark):
    texts = ["  a b\n\tc ", "", "x"]
    assert apply(spark, tx.token_count, *texts) == [3, 0, 1]
    assert apply(spark, tx.tokens, *texts) == [t.split() for t in texts]
    assert apply(spark, tx.words, "L'Été, 2 x!") == [["l", "été", "2", "x"]]


def test_parts(spark):
    reply = {"summary": "S", "number_of_parts": 2, "parts": [
        {"sub_header": "h1", "code": "c1", "explanation": "e1"}, {"sub_header": "h2", "code": "c2", "explanation": "e2"}]}
    empty = {"summary": "S", "number_of_parts": 0, "parts": []}

    def build(t):
        r = jsonx.parse_reply(t, schemas.REPLY_WITH_PARTS)
        return tx.join_parts(r["summary"], r["parts"], F.lit("End"))

    assert apply(spark, build, json.dumps(reply), json.dumps(empty)) == [
        "# S\n\n## h1\ne1\nc1\n\n## h2\ne2\nc2\n\nEnd", "# S\n\nEnd"]


REPLIES = [
    '{"sentiment":"happy","aggressiveness":1,"language":"english"}',
    '{"sentiment":"happy","language":"english"}',
    '{"sentiment":"angry","aggressiveness":9,"language":"english"}',
    '{"sentiment":"sad","aggressiveness":"high","language":"italian"}',
    "{'sentiment':'sad','aggressiveness':5,'language':'german'}",
    "not json",
]


def test_validate(spark):
    df = spark.createDataFrame(list(enumerate(REPLIES)), "i long, reply string")
    got = {r.i: r for r in jsonx.validate(df, "reply", jsonx.TAGS).collect()}
    assert [got[i].valid for i in range(6)] == [True, False, False, False, True, False]
    assert got[1].errors == ["aggressiveness: missing"]
    assert got[2].errors == ["sentiment: not allowed", "aggressiveness: not allowed"]
    assert got[3].errors == ["aggressiveness: missing"] and got[3].language == "italian"
    assert len(got[5].errors) == 3
    good, bad = jsonx.quarantine(jsonx.validate(df, "reply", jsonx.TAGS))
    assert (good.count(), bad.count()) == (2, 4)


def test_replies(spark):
    raw_break = '{"SQL": "SELECT 1\nFROM t", "Explanation": "x"}'
    assert apply(spark, lambda t: jsonx.parse_reply(t, schemas.SQL_REPLY)["SQL"], raw_break) == ["SELECT 1\nFROM t"]
    jokes = [(1, '{"jokes":[{"setup":"a","punchline":"b"},{"setup":"c"}]}'), (2, '{"jokes":[]}'), (3, "oops")]
    rows = jsonx.reply_rows(spark.createDataFrame(jokes, "i long, reply string"), "reply", schemas.JOKES_REPLY, "jokes")
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "a", "b"), (1, "c", None)]


def test_epoch_text_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.range(1).select(epoch_text(F.lit(1_700_000_000).cast("long")).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == "2023-11-14 22:13:20"
