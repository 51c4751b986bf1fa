import base64
import hashlib

import pytest
from pyspark.errors import PySparkException

from tidemill.llm.warc import archive_pages, read_archive, reconstruct, write_archive

DDL = "page_id long, url string, html string, strong string, key string, body string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "s", "k", "b") for r in rows], DDL)


def brute(rows):
    bodies = [(r[0], (r[2] or "").encode()) for r in rows]
    first = {}
    for page, body in bodies:
        if page is not None:
            first[body] = min(first.get(body, page), page)
    out, seen = [], set()
    for page, body in bodies:
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        response = page == first.get(body) and body not in seen
        if response:
            seen.add(body)
        out.append((page, len(body), digest, "response" if response else "revisit", None if response else first.get(body)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [
        (5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, "http://a/9", "same"), (4, None, None), (2, "http://a/2", ""),
        (7, "http://a/\r\n7 x", "é日"), (8, "http://a/8", "x" * 300000), (8, "http://a/8", "x" * 300000), (8, "http://b/8", "x" * 300000),
        (6, "u", "WARC/1.1\r\n\r\n"), (None, "u", "same"), (10, "u", "other"), (10, "u", "third"),
    ]
    assert sorted(map(tuple, archive_pages(spark, pages(spark, rows)).collect()), key=str) == brute(rows)


def test_pages_without_id(spark):
    rows = [(None, "u", "a"), (None, "u", "a"), (None, "v", "b")]
    got = sorted(r["record_type"] for r in archive_pages(spark, pages(spark, rows)).collect())
    assert got == ["response", "response", "revisit"]


def test_empty_table(spark):
    assert archive_pages(spark, pages(spark, [])).collect() == []


def parsed(record):
    """A WARC record read strictly: header fields, HTTP header, payload."""
    head, rest = record.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    assert version == "WARC/1.1" and rest[len(block):] == b"\r\n\r\n"
    http, payload = block.split(b"\r\n\r\n", 1)
    return fields, http, payload


def test_records_are_reconstructed(spark, root):
    rows = [(1, "http://a/1", "ä\r\n\r\nb"), (2, "http://a/2", "ä\r\n\r\nb"), (3, "http://a/\n3", ""), (4, None, "c")]
    write_archive(pages(spark, rows), root)
    got = {r["key"]: parsed(bytes(r["record"])) for r in reconstruct(spark, root).collect()}
    ids = {k: f["WARC-Record-ID"] for k, (f, _, _) in got.items()}
    assert [got[k][0]["WARC-Type"] for k in (1, 2, 3, 4)] == ["response", "revisit", "response", "response"]
    assert [got[k][2] for k in (1, 2, 3, 4)] == ["ä\r\n\r\nb".encode(), b"", b"", b"c"]
    assert got[2][0]["WARC-Refers-To"] == ids[1] and len(set(ids.values())) == 4
    assert got[3][0]["WARC-Target-URI"] == "http://a/%0A3" and "WARC-Target-URI" not in got[4][0]
    assert got[2][0]["WARC-Payload-Digest"] == got[1][0]["WARC-Payload-Digest"]
    assert spark.read.parquet(f"{root}/payloads").count() == 3


def test_short_payloads_are_all_kept_above_a_limit(spark, root):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    write_archive(pages(spark, rows), root, least=3)
    got = {r["key"]: r["record_type"] for r in read_archive(spark, root).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_damage_is_found(spark, root):
    write_archive(pages(spark, [(1, "u", "abc")]), root)
    damaged = spark.read.parquet(f"{root}/payloads").selectExpr("strong", "cast('abd' as binary) AS body").collect()
    spark.createDataFrame(damaged, "strong string, body binary").write.mode("overwrite").parquet(f"{root}/payloads")
    with pytest.raises(PySparkException):
        read_archive(spark, root).collect()
