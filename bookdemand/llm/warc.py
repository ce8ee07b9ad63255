"""WARC archives: write captures, read records, assemble transactions.

A capture is three records: request, response (or revisit) and metadata; the first and
last name the second in WARC-Concurrent-To.  Archives are written by Spark's text
writer (records end in two line breaks, which is its separator) and read back by
content length, so payloads may hold anything, record headers included.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
RECORD_SCHEMA = ("warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, warc_date string, "
                 "content_type string, header_digest string, fields map<string,string>, http_head string, "
                 "payload_bytes long, payload_sha1 string, payload binary")


# ---------------------------------------------------------------- writing

def _id(kind: str) -> Column:
    """A record id that follows from the capture alone, so a task that runs again writes the same."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("page_id", "url", "digest")]
    h = F.md5(F.concat_ws("\1", F.lit(kind), *parts).cast("binary"))
    at = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in at]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; line breaks in the value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, record_id: Column, content_type: str, block: Column, date: str, *lines: Column) -> Column:
    return F.concat(F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), _line("WARC-Date", F.lit(date)),
                    _line("WARC-Target-URI", F.col("url")), *lines, _line("Content-Type", F.lit(content_type)),
                    _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def with_roles(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """page_id, url, payload, digest, payload_bytes and answers: the page_id of the response
    that a revisit repeats, null for a response.

    Of captures with one payload of at least ``min_revisit_bytes`` that with the largest
    page_id is the response (rows that tie for it all are); rows without a page_id
    revisit it too; if no row of the payload has one, all are responses.
    """
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
            .withColumn("digest", F.sha1(F.col("payload").cast("binary")))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")))
    groups = (rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("answers"), F.count("*").alias("n"), F.max_by("url", "page_id").alias("answer_url"))
              .where("n > 1 and answers is not null").drop("n"))
    linked = rows.join(groups, "digest", "left")
    repeats = F.col("answers").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("answers")))
    return linked.withColumn("answers", F.when(repeats, F.col("answers")))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z",
                   captures_per_file: int = 20_000) -> None:
    """Write a capture for each row of ``pages`` (page_id, url, html) to gzipped archives
    under ``path``, at most ``captures_per_file`` in each.

    Null html is an empty payload, a null url or page_id leaves its field out.  Other
    columns are not read; an empty table writes an archive without records.
    """
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("answers").isNotNull()
    host = F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-z]+://([^/?#\s]*)", 1), F.lit("")), F.lit("unknown.invalid"))
    target = F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-z]+://[^/?#\s]*([^#\s]*)", 1), F.lit("")), F.lit("/"))
    refers = F.when(revisit, _id_of_answer())
    content = _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), _id("content"), "application/http; msgtype=response",
                      F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))), date,
                      _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), _line("WARC-Refers-To", refers),
                      _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))))
    request = _record(F.lit("request"), _id("request"), "application/http; msgtype=request",
                      F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)), date, _line("WARC-Concurrent-To", _id("content")))
    about = F.concat(F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
                     F.lit("payload_bytes: "), F.col("payload_bytes").cast("string"), F.lit("\r\n"))
    metadata = _record(F.lit("metadata"), _id("metadata"), "application/warc-fields", about, date, _line("WARC-Concurrent-To", _id("content")))
    text = F.concat_ws(END, request, content, metadata)
    (with_roles(pages, min_revisit_bytes).select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", captures_per_file).text(path))


def _id_of_answer() -> Column:
    """The content record's id of the capture that a revisit refers to."""
    parts = [F.col("answers").cast("string"), F.coalesce(F.col("answer_url"), F.lit("\0")), F.col("digest")]
    h = F.md5(F.concat_ws("\1", F.lit("content"), *parts).cast("binary"))
    at = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in at]), F.lit(">"))


# ---------------------------------------------------------------- reading

class _Unzipped(io.RawIOBase):
    """The bytes of concatenated gzip members (or of a plain file), decompressed as they are read."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.plain = memoryview(data), 0, data[:2] != b"\x1f\x8b"
        self.member = None if self.plain else zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        if self.plain:
            part = self.data[self.at:self.at + len(into)]
            self.at += len(part)
            into[:len(part)] = part
            return len(part)
        while True:
            if self.member.eof:
                rest = self.member.unused_data
                if not rest and self.at >= len(self.data):
                    return 0
                self.at -= len(rest)
                self.member = zlib.decompressobj(31)
            part = self.member.unconsumed_tail
            if not part:
                part = self.data[self.at:self.at + (1 << 16)]
                self.at += len(part)
            if not len(part):
                return 0
            got = self.member.decompress(part, len(into))
            if got:
                into[:len(got)] = got
                return len(got)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if ":" in line)}


def parse(data: bytes, keep_payload: bool) -> Iterator[dict]:
    """The records of one archive.  A record whose length is missing or cut short is an error."""
    stream = io.BufferedReader(_Unzipped(data), 1 << 20)
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = []
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            head.append(line)
        h = _fields(b"".join(head))
        block = stream.read(int(h["content-length"]))
        if len(block) < int(h["content-length"]):
            raise ValueError("the archive ends inside a record")
        kind, http, payload = h.get("content-type", ""), None, block
        if kind.startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
        repeat = h.get("warc-type") == "revisit"
        yield {
            "warc_type": h.get("warc-type"), "record_id": h.get("warc-record-id"), "concurrent_to": h.get("warc-concurrent-to"),
            "refers_to": h.get("warc-refers-to"), "target_uri": h.get("warc-target-uri"), "warc_date": h.get("warc-date"),
            "content_type": kind or None, "header_digest": h.get("warc-payload-digest"),
            "fields": list((_fields(block) if kind == "application/warc-fields" else _fields(http.partition(b"\r\n")[2]) if http is not None else {}).items()),
            "http_head": None if http is None else http.decode("utf-8", "replace"),
            "payload_bytes": None if repeat else len(payload), "payload_sha1": None if repeat else hashlib.sha1(payload).hexdigest(),
            "payload": payload if keep_payload else None,
        }


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """The records under ``path`` (RECORD_SCHEMA): headers, the fields of HTTP and metadata
    blocks, and of each payload its size, SHA-1 and, if wanted, its bytes.  A revisit's
    size and SHA-1 are null: its payload is elsewhere."""
    text = pa.string()
    schema = pa.schema([(c, text) for c in ("warc_type", "record_id", "concurrent_to", "refers_to", "target_uri", "warc_date", "content_type", "header_digest")]
                       + [("fields", pa.map_(text, text)), ("http_head", text), ("payload_bytes", pa.int64()), ("payload_sha1", text), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for record in parse(content.as_py(), keep_payload):
                    rows.append(record)
                    size += len(record["payload"] or b"") + 1000
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


# ---------------------------------------------------------------- transactions

def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, response (the response or revisit record),
    request, metadata (null if there is none) and copies.

    Records of a type that share an id, or a concurrent-to id, are one record written
    several times: one of them is taken, and ``copies`` counts the responses.  Requests
    and metadata that name no response, and records of other types, are left out.
    """
    columns = F.struct(*records.columns)
    whole = (records.where(F.col("warc_type").isin("response", "revisit") & F.col("record_id").isNotNull())
             .groupBy("record_id").agg(F.first(columns).alias("response"), F.count("*").alias("copies")))

    def beside(kind: str) -> DataFrame:
        found = records.where((F.col("warc_type") == kind) & F.col("concurrent_to").isNotNull())
        return found.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.first(columns).alias(kind))

    return (whole.join(beside("request"), "record_id", "left").join(beside("metadata"), "record_id", "left")
            .select("record_id", "response", "request", "metadata", "copies"))
