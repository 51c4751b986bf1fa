"""A content-addressed web archive.

An archive is a folder of two tables. ``payloads`` holds every distinct payload once, under its
SHA-256. ``records`` holds one row per record with the exact bytes of its WARC and HTTP headers and
the key of its payload. Joining them gives back each WARC record byte by byte.

Defined cases: a null payload is an empty one; a null address leaves its header out, and control
characters in an address are percent-encoded; a null id is kept and sorts after all ids; rows that
repeat an id and a payload are a record each, of which one is the response and the rest revisit it;
an empty table is an empty archive; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.shared import run_dir

# Names and texts of the WARC 1.1 and HTTP formats, and the base32 alphabet.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
NEWLINE = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a digest given in hex, for lengths that are multiples of 5 hex digits (SHA-1: 40)."""
    groups = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.conv(F.substr(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int"),
    )
    letter = lambda value: F.substr(F.lit(ALPHABET), value.bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.array_join(
        F.transform(groups, lambda g: F.concat(*[letter(F.shiftright(g, s)) for s in (15, 10, 5, 0)])), ""
    )


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(NEWLINE)), F.lit(""))


def _record_id(key: Column, address: Column, copy: Column) -> Column:
    mark = F.lower(F.hex(F.xxhash64(F.col("strong"), address)))
    parts = [F.coalesce(key.cast("string"), F.lit("none")), mark, copy.cast("string")]
    return F.concat(F.lit("<urn:x-page:"), F.concat_ws(":", *parts), F.lit(">"))


def _safe(address: Column) -> Column:
    """An address without the characters that would end or fold a header line."""
    marked = F.transform(F.split(address, ""), lambda c: F.when(c <= " ", F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(address.rlike("[\\x00-\\x20]"), F.array_join(marked, "")).otherwise(address)


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", address: str = "url", payload: str = "html",
    least: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``pages`` as an archive. Of equal payloads of ``least`` bytes or more, the record with the
    smallest key is a response that keeps the payload; the others are revisits of it.

    Digests are shuffled first, without the pages. Only the pages that are stored move, once, by
    their key. Equality is by SHA-256, checked by length and a second hash of all members of a group.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    pages = pages.select(
        F.col(key).alias("key"), F.col(address).alias("address"), body.alias("body"), F.sha2(body, 256).alias("strong")
    )
    facts = pages.select(
        "key", "address", "strong", F.sha1("body").alias("sha1"),
        F.octet_length("body").cast("long").alias("size"), F.xxhash64("body").alias("second"),
    )
    # Repeated rows become one row with a count before anything else.
    facts = facts.groupBy("key", "address", "strong", "sha1", "size", "second").agg(F.count("*").alias("copies"))
    same = (F.col("least_size") == F.col("most_size")) & (F.col("least_second") == F.col("most_second"))
    firsts = (
        facts.groupBy("strong")
        .agg(
            F.min(F.struct(F.col("key").isNull(), "key", "address")).alias("first"),
            F.min("size").alias("least_size"), F.max("size").alias("most_size"),
            F.min("second").alias("least_second"), F.max("second").alias("most_second"),
        )
        .select(
            F.when(same, F.col("strong")).otherwise(F.raise_error(F.lit("different payloads have one SHA-256"))).alias("strong"),
            F.col("first.key").alias("first_key"), F.col("first.address").alias("first_address"),
        )
    )
    records = facts.join(firsts, "strong").select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    is_first = F.col("key").eqNullSafe(F.col("first_key")) & F.col("address").eqNullSafe(F.col("first_address"))
    response = (F.col("size") < least) | (is_first & (F.col("copy") == 1))
    http = F.concat(F.lit(HTTP), F.col("size").cast("string"), F.lit(NEWLINE * 2))
    block = F.octet_length(http) + F.when(response, F.col("size")).otherwise(0)
    warc = F.concat(
        F.lit(VERSION + NEWLINE),
        _header("WARC-Type", F.when(response, "response").otherwise("revisit")),
        _header("WARC-Record-ID", _record_id(F.col("key"), F.col("address"), F.col("copy"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _safe(F.col("address"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        _header("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        _header("WARC-Refers-To", F.when(~response, _record_id(F.col("first_key"), F.col("first_address"), F.lit(1)))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", block.cast("string")),
        F.lit(NEWLINE),
    )
    records.select("key", warc.alias("warc_header"), http.alias("http_header"), "strong").write.parquet(f"{path}/records")
    # A null key stands as the smallest number, so that the rows which the join brings together are
    # also where repeated rows meet, and the bytes are shuffled once.
    place = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(-(1 << 63))).alias("place")
    stored = pages.select("strong", place("key"), "body").join(firsts.select("strong", place("first_key")), ["strong", "place"])
    stored.dropDuplicates(["strong", "place"]).select("strong", "body").write.parquet(f"{path}/payloads")


def field(header: str | Column, name: str) -> Column:
    """A field of a header block, or null."""
    header = F.col(header) if isinstance(header, str) else header
    found = F.regexp_extract(header, f"(?m)^{name}: ([^\\r\\n]*)", 1)
    return F.when(found != "", found)


def payload_facts(spark: SparkSession, path: str) -> DataFrame:
    """``strong, sha1, size`` of every stored payload, from its bytes; a payload that does not have
    the digest it is stored under is an error."""
    sound = F.sha2("body", 256) == F.col("strong")
    checked = F.when(sound, F.sha1("body")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("strong"))))
    return spark.read.parquet(f"{path}/payloads").select("strong", checked.alias("sha1"), F.octet_length("body").cast("long").alias("size"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record from the stored headers: ``key, record_type, record_id, refers_to`` (a
    record id), ``address, digest`` (as the header states it), ``strong``, and ``sha1, size`` found
    from the stored bytes."""
    records = spark.read.parquet(f"{path}/records").select(
        "key", "strong",
        field("warc_header", "WARC-Type").alias("record_type"),
        field("warc_header", "WARC-Record-ID").alias("record_id"),
        field("warc_header", "WARC-Refers-To").alias("refers_to"),
        field("warc_header", "WARC-Target-URI").alias("address"),
        field("warc_header", "WARC-Payload-Digest").alias("digest"),
    )
    return records.join(payload_facts(spark, path), "strong")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``key, record``: the bytes of every WARC record, header, block and end."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    keeps = F.when(field("warc_header", "WARC-Type") == "response", F.col("body")).otherwise(F.lit(b""))
    binary = lambda name: F.col(name).cast("binary")
    return records.join(payloads, "strong").select(
        "key", F.concat(binary("warc_header"), binary("http_header"), keeps, F.lit(NEWLINE * 2).cast("binary")).alias("record")
    )


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder, read the archive back, and describe each record."""
    path = run_dir(spark, "warc")
    write_archive(pages, path)
    digest = base32_of_hex(F.col("sha1"))
    agrees = F.col("digest") == F.concat(F.lit("sha1:"), digest)
    checked = F.when(agrees, digest).otherwise(F.raise_error(F.lit("a header's digest differs from its payload's")))
    return read_archive(spark, path).select(
        F.col("key").alias("page_id"), F.col("size").alias("payload_bytes"), checked.alias("payload_digest"), "record_type",
        F.regexp_extract("refers_to", "^<urn:x-page:(-?\\d+):", 1).alias("__refers"),
    ).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.length("__refers") > 0, F.col("__refers")).cast("long").alias("refers_to"),
    )



def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(spark, spark.read.parquet(f"{folder}/pages.parquet"))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    ('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
