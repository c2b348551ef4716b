"""WARC archives: one request, one response or revisit, and one metadata record per page,
written by Spark, read back, and assembled into one nested row per capture.

Writing. Records are text, so Spark's text writer with the record end as line separator makes
the archives, in the shared folder and in any store Spark can write. Pages with equal
payloads of at least ``min_revisit_bytes`` bytes keep one response, that of the largest
page_id; the others are revisit records that carry the HTTP headers and the digest but no
payload. A file holds at most ``pages_per_file`` pages.

Reading. A task walks through an archive by Content-Length, one record at a time, and checks
each payload against its digest. Request and metadata records name the response or revisit
record they belong to in WARC-Concurrent-To; the assembly groups by that identifier.

Defined results: a null html is the empty payload; a null url gives records without a target;
rows that repeat a page stay separate captures; pages with a null page_id are revisits when
an equal payload has an id, otherwise responses; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage, scratch_path

MIN_REVISIT_BYTES, PAGES_PER_FILE = 0, 4000
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = "type string, record_id string, concurrent_to string, target string, date string, http string, fields string, payload_bytes long, payload_digest string, payload binary"


def base32_of_hex(hexed: Column) -> Column:
    """Base32 of a 40-digit hex number: five hex digits are four base32 signs."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [F.lpad(F.conv(F.substring(hexed, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), digits, BASE32)


def _uuid(kind: str) -> Column:
    h = F.md5(F.concat_ws("/", F.lit(kind), F.col("page_id").cast("string"), F.col("digest"), F.col("row").cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str | Column, block: Column, content_type: str, *headers: Column) -> Column:
    """A record without its end; null headers are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.lit(f"WARC-Date: {DATE}"), *headers,
        F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END), block)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, pages_per_file: int = PAGES_PER_FILE) -> None:
    """Write the records of pages(page_id, url, html) below ``path``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", F.translate("url", "\r\n", "").alias("url"), payload.alias("payload"))
    base = base.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": base32_of_hex(F.sha1(F.encode("payload", "UTF-8")))})
    copies = base.filter(F.col("bytes") >= min_revisit_bytes).groupBy(F.col("digest").alias("_digest"))
    copies = copies.agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_top")).filter("_n > 1 and _top is not null")
    copies = cut_lineage(copies.drop("_n"))
    rows = base.join(copies, F.col("digest") == F.col("_digest"), "left").withColumn("row", F.monotonically_increasing_id())
    again = F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    target = _line("WARC-Target-URI", F.col("url"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    answer = _record(
        F.when(again, "revisit").otherwise("response"), F.when(again, http).otherwise(F.concat(http, F.col("payload"))), "application/http;msgtype=response",
        _line("WARC-Record-ID", _uuid("response")), target, digest, F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
    )
    concurrent = _line("WARC-Concurrent-To", _uuid("response"))
    asked = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END))
    request = _record("request", asked, "application/http;msgtype=request", _line("WARC-Record-ID", _uuid("request")), target, concurrent)
    told = F.concat_ws("\r\n", _line("page-id", F.col("page_id").cast("string")), F.when(again, _line("refers-to-page-id", F.col("_top").cast("string"))), F.lit(""))
    metadata = _record("metadata", told, "application/warc-fields", _line("WARC-Record-ID", _uuid("metadata")), target, concurrent)
    records = rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * pages_per_file).text(path)


def headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (x.decode("utf-8").partition(":") for x in lines if b":" in x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_archive(content: bytes, with_payload: bool) -> Iterator[tuple]:
    """The records of one archive, plain or compressed (also with one member per record), as they stand."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:60]!r}")
        head = []
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            head.append(line)
        own = headers(head)
        block = stream.read(int(own["content-length"]))
        kind, http, fields, payload, size, digest = own["warc-type"], None, None, None, None, None
        if kind == "metadata":
            fields = block.decode("utf-8")
        elif own.get("content-type", "").startswith("application/http"):
            start = block.find(b"\r\n\r\n") + 4
            http, body = block[:start].decode("utf-8"), block[start:]
            digest = own.get("warc-payload-digest", "").removeprefix("sha1:") or None
            if kind == "response":
                payload, size = body, len(body)
                found = base64.b32encode(hashlib.sha1(body).digest()).decode()
                if digest not in (None, found):
                    raise ValueError(f"payload of {own['warc-record-id']} does not match its digest")
                digest = found
            elif kind == "revisit":
                size = int(headers(block[:start].split(b"\r\n")).get("content-length", 0))
        yield (kind, own["warc-record-id"], own.get("warc-concurrent-to"), own.get("warc-target-uri"), own.get("warc-date"), http, fields, size, digest, payload if with_payload else None)


def read_records(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of archives given as binary files(content)."""
    names = [c.split(" ")[0] for c in RECORD.split(", ")]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                part, held = [], 0
                for record in parse_archive(content, with_payload):
                    part.append(record)
                    held += len(record[-1] or b"")
                    if len(part) >= 2000 or held > 16 << 20:
                        yield pd.DataFrame(part, columns=names).astype({"payload_bytes": "Int64"})
                        part, held = [], 0
                if part:
                    yield pd.DataFrame(part, columns=names).astype({"payload_bytes": "Int64"})

    return files.select("content").mapInPandas(walk, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, target, date, request, response, metadata)."""
    def part(*kinds: str) -> Column:
        inner = ["type", "record_id", "http", "fields", "payload_bytes", "payload_digest", "payload"]
        return F.max_by(F.struct(*inner), F.when(F.col("type").isin(*kinds), F.col("record_id")))

    grouped = records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id")).groupBy("capture_id")
    return grouped.agg(
        F.max("target").alias("target"), F.max("date").alias("date"), part("request").alias("request"), part("response", "revisit").alias("response"), part("metadata").alias("metadata")
    )


def round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, pages_per_file: int = PAGES_PER_FILE, with_payload: bool = False) -> DataFrame:
    """Write the archives of pages to the shared scratch folder and assemble them again."""
    path = scratch_path(pages.sparkSession)
    write_archives(pages, path, min_revisit_bytes, pages_per_file)
    files = pages.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return captures(read_records(files, with_payload))


def page_records(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from captures."""
    def field(name: str) -> Column:
        got = F.regexp_extract("metadata.fields", rf"(?m)^{name}: (-?[0-9]+)\r?$", 1)
        return F.when(got != "", got).cast("long")

    return found.select(
        field("page-id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), field("refers-to-page-id").alias("refers_to"),
    )
