"""WARC archives (operator 11): index first, then coalesced byte-range reads.

* Payloads that occur more than once are known from their digests before
  anything is written (one aggregate over ids, URLs and digests; no payload is
  moved). The row with the largest (id, URL) of a digest becomes a response, its
  other rows revisits that name it.
* Tasks stream their rows into archives of their own, one gzip member per
  record, in the shared folder, and give an index row per record: archive,
  offset, length, URL, digest. An archive has a fresh name, so an attempt that is
  repeated writes another one; the index, a table that Spark commits, names only
  archives of finished attempts, and readers go through the index alone.
* A read takes any selection of index rows, sorts it by archive and offset in
  contiguous ranges, one per task, and joins neighbours whose gap is at most
  ``gap`` bytes into one read of at most ``read_bytes`` (one longer record is a
  read of its own). Every record is checked against its index row and its digest.

Archives are written and read with ``pyarrow.fs``, by the URI of the folder
(local path, file, hdfs, s3, gs); pages are read by Spark alone.

Defined cases: null html is an empty payload; a null id is smaller than any
other; a null URL leaves the header out; identical rows are one response and
revisits of it; an empty table gives no archive and no rows; extra columns are
ignored. Headers hold ids and URLs with control characters and '%' percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, scratch_path
from . import common

ARCHIVE_BYTES = 1 << 30      # an archive ends after the record that passes this
BUFFER_BYTES = 1 << 22
READ_BYTES = 1 << 23
GAP_BYTES = 1 << 16
TASK_BYTES = 1 << 23         # compressed bytes a reading task should have
LEAST_BYTES = 0              # shorter payloads are always responses
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(html: Column) -> Column:
    """Base32 of the SHA-1, from its hexadecimal form: five hex digits are four letters."""
    hexed = F.sha1(F.encode(html, "UTF-8"))
    letters = []
    for at in range(1, 41, 5):
        value = F.conv(F.substring(hexed, at, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*letters)


def marked_pages(pages: DataFrame, *, id_col: str, url_col: str, html_col: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``id``, ``url``, ``html``, ``digest``, and for revisits ``refers_to_id`` and
    ``refers_to_url``; ``revisit`` tells them apart."""
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", payload_digest(F.col("html")))
    who = F.struct("id", "url")
    counted = (rows.filter(F.octet_length("html") >= least_bytes).select("id", "url", "digest")
               .groupBy("digest", "id", "url").agg(F.count(F.lit(1)).alias("n")))
    # struct order has nulls first, as the largest id asks for
    shared = durable(counted.groupBy("digest").agg(F.max(F.struct("id", "url", "n")).alias("first"), F.sum("n").alias("rows"))
                     .filter(F.col("rows") > 1)
                     .select(F.col("digest").alias("_digest"), F.struct("first.id", "first.url").alias("_first"),
                             F.col("first.n").alias("_n")), "shared-payloads")
    joined = rows.join(shared, (rows["digest"] == shared["_digest"]) & (F.octet_length("html") >= least_bytes), "left")
    columns = ["id", "url", "html", "digest", "_first"]
    chosen = who.eqNullSafe(F.col("_first"))
    out = joined.filter(~(chosen & F.coalesce(F.col("_n") > 1, F.lit(False)))) \
        .withColumn("revisit", F.col("_first").isNotNull() & ~chosen).select(*columns, "revisit")
    if not shared.filter(F.col("_n") > 1).isEmpty():
        # identical rows stand for each other: one is the response, the others revisit it
        copies = (joined.filter(chosen & (F.col("_n") > 1)).groupBy("id", "url", "digest", "_first", "_n")
                  .agg(F.first("html").alias("html"))
                  .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))))
        out = out.unionByName(copies.withColumn("revisit", F.col("_copy") > 1).select(*columns, "revisit"))
    return out.select("id", "url", "html", "digest", "revisit",
                      F.when(F.col("revisit"), F.col("_first.id")).alias("refers_to_id"),
                      F.when(F.col("revisit"), F.col("_first.url")).alias("refers_to_url"))


# ------------------------------------------------------------ records

def _quoted(text: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text)


def record_id(ident: str | None, digest: str, revisit: int = 0) -> str:
    """The URN of a record, the same in every run; revisits count up."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{ident}/{digest}/{revisit}')}>"


def _member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(ident: str | None, url: str | None, payload: bytes, digest: str, date: str,
                refers_to: tuple[str | None, str | None] | None = None, copy: int = 0) -> bytes:
    """A response, or a revisit of the record of ``refers_to`` (id, URL)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    named = [(k, None if v is None else _quoted(v)) for k, v in
             (("WARC-Target-URI", url), ("Page-ID", ident), *((("Refers-To-Page-ID", refers_to[0]),
                                                              ("WARC-Refers-To-Target-URI", refers_to[1])) if refers_to else ()))]
    headers = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id(ident, digest, copy)),
               ("WARC-Date", date), *named, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Length", str(len(payload)))]
    if refers_to:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to[0], digest)), ("WARC-Refers-To-Date", date)]
    return _member([*headers, ("Content-Type", "application/http; msgtype=response")], block)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names, ``:`` the version line) and payload of a record;
    raises on a damaged one."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {":": version} | {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    n = int(headers["content-length"])
    if not version.startswith("WARC/1.") or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"not a whole WARC record: {headers.get('warc-record-id')}")
    return headers, rest[:n].partition(b"\r\n\r\n")[2]


# ------------------------------------------------------------ write, index, read

INDEX = "archive string, offset long, length long, url string, digest string, id string, record_type string"


def _writer(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        stream, name, at, copies = None, None, 0, 0
        index: list[tuple] = []

        def rows():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), (
                pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()))],
                names=["archive", "offset", "length", "url", "digest", "id", "record_type"])
            index.clear()

        try:
            for batch in batches:
                for ident, url, html, digest, revisit, to_id, to_url in zip(*(c.to_pylist() for c in batch.columns)):
                    if stream is None:
                        files.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        stream, at = files.open_output_stream(f"{root}/{name}", compression=None, buffer_size=BUFFER_BYTES), 0
                        info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, "")), ("WARC-Date", date),
                                        ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        stream.write(info)
                        at += len(info)
                    copies += 1
                    # a revisit's number makes its record's name its own
                    own = int.from_bytes(hashlib.sha1(f"{name}/{copies}".encode()).digest()[:6]) if revisit else 0
                    member = page_record(ident, url, html.encode(), digest, date, (to_id, to_url) if revisit else None, own)
                    stream.write(member)
                    index.append((name, at, len(member), url, digest, ident, "revisit" if revisit else "response"))
                    at += len(member)
                    if at >= archive_bytes:
                        stream.close()
                        stream = None
                if index:
                    yield from rows()
        finally:
            if stream is not None:
                stream.close()
    return run


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = LEAST_BYTES, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives into ``folder`` (shared by all executors) and returns
    their stored index, a row per page."""
    marked = marked_pages(pages, id_col=id_col, url_col=url_col, html_col=html_col, least_bytes=least_bytes)
    text = [F.col(c).cast("string").alias(c) for c in ("id", "url", "html", "digest")]
    rows = marked.select(*text, "revisit", F.col("refers_to_id").cast("string"), F.col("refers_to_url").cast("string"))
    return durable(rows.mapInArrow(_writer(folder, date, archive_bytes), INDEX), "warc-index")


RECORD = ("archive string, offset long, url string, id string, record_type string, refers_to string, "
          "payload_bytes long, payload_digest string, payload binary")


def _reader(folder: str, read_bytes: int, gap: int, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        opened: list = [None, None]

        def table(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()))],
                names=["archive", "offset", "url", "id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])

        def records(span: list[tuple]):
            """One read for neighbours of an archive, then a row for each."""
            archive, first = span[0][0], span[0][1]
            if opened[0] != archive:
                if opened[1] is not None:
                    opened[1].close()
                opened[:] = archive, files.open_input_file(f"{root}/{archive}")
            data = opened[1].read_at(span[-1][1] + span[-1][2] - first, first)
            out, held = [], 0
            for _, offset, length, url, digest, kind in span:
                headers, payload = parse_record(data[offset - first:offset - first + length])
                if headers["warc-type"] != kind or headers["warc-payload-digest"] != f"sha1:{digest}":
                    raise ValueError(f"{archive} has another record than its index at {offset}")
                size = int(headers["payload-length"])
                if kind == "response" and (base32_sha1(payload) != digest or len(payload) != size):
                    raise ValueError(f"{archive} has a damaged payload at {offset}")
                ident, to = (headers.get(k) for k in ("page-id", "refers-to-page-id"))
                kept = payload if with_payload and kind == "response" else None
                out.append((archive, offset, url, ident and unquote(ident), kind, to and unquote(to), size, digest, kept))
                held += len(kept or b"")
                if held > BUFFER_BYTES:
                    yield table(out)
                    out, held = [], 0
            if out:
                yield table(out)

        span: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if span and (row[0] != span[0][0] or row[1] - (span[-1][1] + span[-1][2]) > gap
                             or row[1] + row[2] - span[0][1] > read_bytes):
                    yield from records(span)
                    span = []
                span.append(row)
        if span:
            yield from records(span)
        if opened[1] is not None:
            opened[1].close()
    return run


def read_records(index: DataFrame, folder: str, *, read_bytes: int = READ_BYTES, gap: int = GAP_BYTES,
                 task_bytes: int = TASK_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of the selected ``index`` rows, read back and verified. A
    revisit has no payload of its own (null): that of its response has its digest."""
    total = index.agg(F.sum("length")).first()[0] or 0
    rows = (index.select("archive", "offset", "length", "url", "digest", "record_type")
            .repartitionByRange(-(-total // task_bytes) or 1, "archive", "offset").sortWithinPartitions("archive", "offset"))
    return rows.mapInArrow(_reader(folder, read_bytes, gap, with_payload), RECORD)


def archived_pages(pages: DataFrame, folder: str, *, id_col: str = "page_id", **options) -> DataFrame:
    """Writes ``pages`` and reads every record back: ``id_col``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``."""
    kind: T.DataType = pages.schema[id_col].dataType
    records = read_records(write_archives(pages, folder, id_col=id_col, **options), folder, with_payload=False)
    return records.select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(kind).alias("refers_to"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    common.prepare(spark)
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "warc"))


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS response_id,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31)
                AS BIGINT), 1)), '') AS payload_digest
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response_id THEN response_id END AS refers_to
FROM d
"""
