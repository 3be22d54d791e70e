"""WARC archives with an index first, read back by coalesced byte ranges.

``write_archives`` stores one record per row.  Of rows with equal payloads
(SHA-1 and length) the one with the largest id is a ``response``, the others
are ``revisit`` records without a payload that name it.  Each task writes its
own ``.warc.gz`` files, one gzip member per record, below a shared folder and
returns the index rows: path, offset, length, URL, digest.  Only the index of
successful task attempts is committed, so files of lost attempts are never read.

``read_records`` takes any selection of index rows, sorts it by file and
offset, joins ranges that lie close together into one read and parses the
records in it.

Folders are reached through ``pyarrow.fs`` (``file``, ``hdfs``, ``s3``, ``gs``).

Cases: a null payload is empty, a null URL or id stays null.  Rows that share
the largest id of a payload are all responses.  A row without an id answers
for others only if no row of its payload has one; it then answers for itself.
A payload of any length is one record and must fit a task; repeated rows are
records of their own; other columns are never read; no pages, no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import arrow_batch, staged, text_slices
from sluice.session import scratch_dir

ARCHIVE_BYTES = 256 << 20   # an archive is closed beyond this size
GAP_BYTES = 64 << 10        # ranges nearer than this become one read
READ_BYTES = 8 << 20        # a read ends beyond this size

INDEX = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                   ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()),
                   ("record_type", pa.string())])
INDEX_DDL = ("path string, offset long, length long, url string, digest string, "
             "page_id long, record_type string")
RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload", pa.binary())])
RECORD_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, payload binary")


def _open(path: str):
    if path.startswith("file:"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record, its own gzip member."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=~"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Payload-Length: {len(payload)}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=1, mtime=0)


def parse_record(member: bytes) -> dict:
    """The record of one gzip member; raises if block and headers disagree."""
    raw = zlib.decompress(member, wbits=31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block = raw[end + 4:end + 4 + int(head["Content-Length"])]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda uri: int(x) if (x := uri[len("<urn:page:"):-1]) else None
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and sha1_base32(block) != digest:
        raise ValueError("payload does not match its digest")
    return {"page_id": number(head["WARC-Record-ID"]),
            "url": unquote(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
            "payload_bytes": int(head["X-Payload-Length"]) if revisit else len(block),
            "payload_digest": digest, "record_type": head["WARC-Type"],
            "refers_to": number(head["WARC-Refers-To"]) if revisit else None,
            "payload": None if revisit else block}


def revisits(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``sha1, n, of``: for each payload that several rows hold, the id of
    its response (its own table: its measured size decides how it is joined)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return staged(spark, pages.groupBy(F.unhex(F.sha1(html.cast("binary"))).alias("sha1"),
                                       F.octet_length(html).cast("long").alias("n"))
                  .agg(F.max("page_id").alias("of"), F.count(F.lit(1)).alias("rows"))
                  .where("rows > 1 AND of IS NOT NULL").select("sha1", "n", "of"), "warc-of")


def write_archives(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives below ``folder``;
    returns the index, one row per record, as a table."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.unhex(F.sha1(html.cast("binary"))).alias("sha1"),
                        F.octet_length(html).cast("long").alias("n"))
    rows = (rows.join(revisits(spark, pages), ["sha1", "n"], "left")
            .select("page_id", "url", "html", "sha1",
                    F.when(F.col("page_id").eqNullSafe(F.col("of")), None)
                     .otherwise(F.col("of")).alias("refers_to")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        sink, path, offset = None, "", 0
        for batch in text_slices(batches, "html"):
            index = {f.name: [] for f in INDEX}
            for page_id, url, text, sha1, refers_to in zip(
                    *(batch.column(i).to_pylist() for i in range(5))):
                if sink is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    sink, path, offset = (fs.open_output_stream(f"{base}/{name}", compression=None),
                                          f"{folder}/{name}", 0)
                digest = base64.b32encode(sha1).decode()
                member = record_bytes(page_id, url, text.encode(), digest, refers_to)
                sink.write(member)
                for k, v in zip(index, (path, offset, len(member), url, digest, page_id,
                                        "response" if refers_to is None else "revisit")):
                    index[k].append(v)
                offset += len(member)
                if offset >= ARCHIVE_BYTES:
                    sink.close()
                    sink = None
            yield arrow_batch(INDEX, index)
        if sink is not None:
            sink.close()

    return staged(spark, rows.mapInArrow(write, INDEX_DDL), "warc-index")


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the index rows ``(path, offset, length)``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, opened = None, None
        out, held = {f.name: [] for f in RECORD}, 0
        for batch in batches:
            paths, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            at = 0
            while at < len(paths):
                stop, end = at + 1, offsets[at] + lengths[at]
                while (stop < len(paths) and paths[stop] == paths[at]
                       and offsets[stop] - end <= GAP_BYTES
                       and offsets[stop] + lengths[stop] - offsets[at] <= READ_BYTES):
                    end = max(end, offsets[stop] + lengths[stop])
                    stop += 1
                if opened != paths[at]:
                    if source is not None:
                        source.close()
                    fs, path = _open(paths[at])
                    source, opened = fs.open_input_file(path), paths[at]
                block = memoryview(source.read_at(end - offsets[at], offsets[at]))
                for i in range(at, stop):
                    first = offsets[i] - offsets[at]
                    record = parse_record(block[first:first + lengths[i]])
                    if not with_payload:
                        record["payload"] = None
                    for k in out:
                        out[k].append(record[k])
                    held += len(record["payload"] or b"") + 100
                    if held >= READ_BYTES:
                        yield arrow_batch(RECORD, out)
                        out, held = {f.name: [] for f in RECORD}, 0
                at = stop
        if source is not None:
            source.close()
        if held:
            yield arrow_batch(RECORD, out)

    # tasks by the bytes they will read, which the index's own size does not show
    total = index.agg(F.sum("length")).first()[0] or 0
    stretch = F.expr(f"offset div {2 * READ_BYTES}")
    return (index.select("path", "offset", "length")
            .repartition(max(1, -(-total // (2 * READ_BYTES))), "path", stretch)
            .sortWithinPartitions("path", "offset")
            .mapInArrow(read, RECORD_DDL))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    index = write_archives(spark, table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return read_records(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS h FROM p),
m AS (SELECT n, h, max(page_id) AS of FROM d GROUP BY n, h)
SELECT d.page_id, d.n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(d.h, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)),
         '') AS payload_digest,
       CASE WHEN d.page_id = m.of THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id = m.of THEN NULL ELSE m.of END AS refers_to
FROM d JOIN m USING (n, h)
"""
