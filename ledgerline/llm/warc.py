"""WARC archives: writing captures, and assembling them back into nested rows.

A capture is a transaction of three records: the response (or a revisit, where
an equal payload is already stored), the request, and a metadata record with
what the archive format has no field for (the page's id). Request and metadata
name the response they belong to in ``WARC-Concurrent-To``. Reading parses the
archives record by record and joins the three through these identifiers, then
emits one nested row per capture; a revisit gets size and digest of its payload
from the response that it refers to.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with
the smallest page id is the response, the others are revisits.

How the work is spread: Spark's text writer writes the archives (gzip), with
the record terminator as line separator, so a task that fails leaves no half file;
files hold at most ``records_per_file`` records and, pages of more than
``large_bytes`` being written apart, at most about ``file_bytes`` (or one
capture). A reader holds a file's compressed bytes and a batch of records of
about 8 MB (or one longer record). Payloads are found equal by their digests.
Only digests that occur twice are joined back; they are written first, so that
Spark knows their size and broadcasts them where they are small, else a payload
that a third of all pages share is a hot key of a left join, which adaptive
execution splits.

Defined cases: a null html is an empty payload; a null url is written without
target; control characters in a url are percent-encoded; a null page id is the
largest, and is kept as null; repeated rows are captures of their own (with
equal identifiers, so their requests and metadata are equal too); several
rows of the smallest id with one payload are all responses; blank lines or
record headers inside a payload do no harm, since lengths are followed.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_dir

# Parts of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
TERMINATOR = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, uri string, date string, "
    "payload_digest string, head string, payload string"
)


def _uuid(*parts) -> Column:
    """A record id made from the given values (null is a value of its own)."""
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts])
    return F.concat(
        F.lit("<urn:uuid:"),
        F.regexp_replace(F.md5(text.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
        F.lit(">"),
    )


def _record(block: Column, *fields) -> Column:
    """Header lines (those whose value is null are left out), a blank line, the block."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(TERMINATOR), block)


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 100,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = 6000,
    large_bytes: int = 262_144,
    file_bytes: int = 1_000_000_000,
) -> None:
    """Three records per row of ``pages`` below ``path``."""
    spark = pages.sparkSession
    encoded = F.col(url)
    for c in [*range(0x21), 0x7F]:
        encoded = F.replace(encoded, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    safe_url = F.when(F.col(url).rlike("[\\x00-\\x20\\x7F]"), encoded).otherwise(F.col(url))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        safe_url.alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    ).select("*", F.sha2(F.col("payload").cast("binary"), 256).alias("digest"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url"))
    size, copies = F.octet_length("payload"), shared_dir(spark, "warc_copies")
    (
        rows.filter(size >= least_bytes)
        .select("page_id", "url", "digest")
        .groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
        .write.parquet(copies)
    )
    copied = spark.read.schema("digest string, first_id long, first_url string").parquet(copies)
    rows = rows.join(copied.withColumn("copied", F.lit(True)), "digest", "left")
    revisit = F.col("copied").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    own = _uuid(F.lit("response"), F.col("page_id"), F.col("url"), F.col("digest"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(TERMINATOR),
    )
    when, uri = F.lit(date), F.col("url")
    http = "application/http; msgtype="
    digest = F.concat(F.lit("sha256:"), "digest")
    response = _record(
        F.concat(head, "payload"),
        ("WARC-Type", F.lit("response")),
        ("WARC-Record-ID", own),
        ("WARC-Date", when),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", digest),
        ("Content-Type", F.lit(http + "response")),
    )
    again = _record(
        head,
        ("WARC-Type", F.lit("revisit")),
        ("WARC-Record-ID", own),
        ("WARC-Date", when),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.lit(PROFILE)),
        ("WARC-Refers-To", _uuid(F.lit("response"), F.col("first_id"), F.col("first_url"), F.col("digest"))),
        ("Content-Type", F.lit(http + "response")),
    )
    site = F.coalesce(F.regexp_extract("url", "^[a-z]+://([^/]*)", 1), F.lit(""))
    target = F.coalesce(F.regexp_extract("url", "^[a-z]+://[^/]*(/.*)$", 1), F.lit(""))
    request = _record(
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}Host: "), site, F.lit(TERMINATOR)),
        ("WARC-Type", F.lit("request")),
        ("WARC-Record-ID", _uuid(F.lit("request"), own)),
        ("WARC-Date", when),
        ("WARC-Target-URI", uri),
        ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit(http + "request")),
    )
    metadata = _record(
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)),
        ("WARC-Type", F.lit("metadata")),
        ("WARC-Record-ID", _uuid(F.lit("metadata"), own)),
        ("WARC-Date", when),
        ("WARC-Target-URI", uri),
        ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/warc-fields")),
    )
    records = F.array(request, F.when(revisit, again).otherwise(response), metadata)

    def write(part: DataFrame, most_bytes: int) -> None:
        captures = max(1, min(records_per_file // 3, file_bytes // max(most_bytes, 1)))
        (
            part.select(F.explode(records).alias("value"))
            .write.mode("append")
            .option("lineSep", TERMINATOR)
            .option("maxRecordsPerFile", 3 * captures)
            .option("compression", "gzip")
            .text(path)
        )

    largest = pages.agg(F.max(F.octet_length(F.col(html)))).first()[0] or 0
    write(rows.filter(size <= large_bytes), large_bytes)
    if largest > large_bytes:
        write(rows.filter(size > large_bytes), largest)


def parse(archive: bytes | BinaryIO) -> Iterator[dict]:
    """The records of one archive: header fields (lower-case names) and ``block``.

    A stream is read record by record, so no more than one is held.
    """
    stream = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    number = 0
    while version := stream.readline():
        number += 1
        if not version.startswith(b"WARC/"):
            raise ValueError(f"record {number} does not begin with a version")
        fields = {}
        while (line := stream.readline()) != CRLF.encode():
            if not line:
                raise ValueError(f"the header of record {number} has no end")
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        fields["block"] = stream.read(int(fields["content-length"]))
        if stream.read(len(TERMINATOR)) != TERMINATOR.encode():
            raise ValueError(f"record {number} does not end where its length says")
        yield fields


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (``RECORD``); HTTP blocks are split into head and payload."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kept = ["warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for r in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    block = r["block"].decode()
                    head, _, payload = block.partition(TERMINATOR)
                    if r["warc-type"] != "response":
                        payload = None
                    digest = r.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    rows.append([*(r.get(k) for k in kept), digest, head, payload])
                    held += len(r["block"])
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: page_id, record_type, refers_to (a page id), payload_bytes,
    payload_digest, and the structs response, request and metadata.

    Size and digest are taken from the payload as read; without ``payloads``
    the payload itself goes no further than that.
    """
    spark, path = records.sparkSession, shared_dir(records.sparkSession, "warc_records")
    measured = records.select(
        "*",
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("digest"),
    )
    if not payloads:
        measured = measured.drop("payload")
    measured.write.partitionBy("type").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(measured.schema).parquet(path)

    def beside(kind: str) -> DataFrame:
        fields = F.min(F.struct("record_id", "uri", "date", "head"))
        return (
            stored.filter(F.col("type") == kind)
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(fields.alias(kind))
        )

    fields = ["record_id", "uri", "date", "head", *["payload"] * payloads, "payload_digest"]
    page = F.regexp_extract("metadata.head", "page-id: (-?[0-9]+)", 1)
    captures = (
        stored.filter(F.col("type").isin("response", "revisit"))
        .select(
            "type",
            "record_id",
            "refers_to",
            "bytes",
            "digest",
            F.struct(*fields).alias("response"),
        )
        .join(beside("request"), "record_id", "left")
        .join(beside("metadata"), "record_id", "left")
        .withColumn("page_id", F.when(page != "", page.cast("long")))
    )
    told = captures.filter("type = 'response'")
    original = told.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("page_id").alias("to_page"), F.min("bytes").alias("to_bytes"), F.min("digest").alias("to_digest")
    )
    parts = ["response", "request", "metadata"]
    first = told.select(
        "page_id",
        F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        *parts,
    )
    again = (
        captures.filter("type = 'revisit'")
        .join(original, "refers_to", "left")
        .select(
            "page_id",
            F.col("type").alias("record_type"),
            F.col("to_page").alias("refers_to"),
            F.col("to_bytes").alias("payload_bytes"),
            F.coalesce("to_digest", "response.payload_digest").alias("payload_digest"),
            *parts,
        )
    )
    return first.unionAll(again)


def archive_and_read(
    pages: DataFrame, path: str | None = None, payloads: bool = True, **options
) -> DataFrame:
    """Write ``pages`` as archives and return the captures read back from them."""
    path = path or shared_dir(pages.sparkSession, "warc")
    write_archive(pages, path, **options)
    return assemble(read_archive(pages.sparkSession, path), payloads)
