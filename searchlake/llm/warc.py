"""Operator 9: WARC archives, written with deduplicated payloads and read back in splits.

Writing. Every row becomes one gzip member that holds one WARC/1.1 record. Of
rows with equal payloads of at least ``min_bytes`` bytes, the one with the
largest id is a ``response``; the others are ``revisit`` records, which carry the
payload's digest and, in their HTTP header, its length, but not the payload.
Equal payloads are found by SHA-256 with a count and largest id per digest,
combined before the shuffle; only digests of several rows are joined back, and
those of more than 1/1000 of the rows by broadcast, so one page that a third of
the rows share is no hot key. The revisits are joined to the pages by id and
digest, so a row becomes one record whatever other rows share its id, and
each task writes what it then holds, in files of about ``file_bytes``.

Reading. Files are listed by Spark and cut into byte ranges. A task scans its
range for the gzip magic, checks a candidate by decoding the start of the member
to a WARC version line, and owns the records that start inside its range; it
reads past the end of the range for its last record. A false magic inside
compressed data fails the check and is passed over.

The folder must be one that all executors share; it is opened with Arrow's file
systems (local or shared mounts, object stores, HDFS).

Cases: null html is an empty payload; payloads of any length are written and read
whole, in time that grows with their length. Rows that share an id are records of
their own, each judged by its payload. Rows with a null id are written as
responses, with an id made of the row's position, and read back with a null id.
Rows that share the largest id are all responses. A member that is cut short
ends the file's records. Other columns are not looked at. An empty table writes
no file and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchlake.session import scratch_path

from .common import prepare, skew_join, stage

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
#: Bytes read at once while scanning.
BLOCK = 1 << 20
SPLIT_BYTES = 16 << 20
FILE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
RECORD_FIELDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
                 "refers_to long, file string, position long")


def _open(path: str):
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None) -> str:
    return f"urn:page:{page}" if page is not None else f"urn:uuid:{uuid.uuid4()}"


def _clean(value: str | None) -> str:
    """A header value: no control characters."""
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value or "")


def encode_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member with one record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{_record_id(page)}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", _clean(url)), ("WARC-Payload-Digest", "sha1:" + digest(payload)),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{_record_id(refers_to)}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    if url is None:
        fields = [f for f in fields if f[0] != "WARC-Target-URI"]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _writer(folder: str, file_bytes: int):
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        system, base = _open(folder)
        stream, name, n, size, files = None, "", 0, 0, 0

        def listed():
            stream.close()
            return pa.RecordBatch.from_arrays([pa.array([posixpath.basename(name)]), pa.array([n]), pa.array([size])],
                                              ["file", "n_records", "bytes"])

        for batch in batches:
            for page, url, html, refers_to in zip(*batch.columns):
                if stream is None:
                    # a retried or doubled attempt writes files of its own; only the committed ones are listed
                    name = posixpath.join(base, f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{files}.warc.gz")
                    system.create_dir(base, recursive=True)
                    stream = system.open_output_stream(name, compression=None)
                record = encode_record(page.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py())
                stream.write(record)
                n, size = n + 1, size + len(record)
                if size >= file_bytes:
                    yield listed()
                    stream, n, size, files = None, 0, 0, files + 1
        if stream is not None:
            yield listed()
    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the records below ``folder``; one row per committed file: file, n_records, bytes."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    keyed = stage(rows.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes)).select(
        "page_id", F.unhex(F.sha2("html", 256)).alias("sha"), F.octet_length("html").cast("long").alias("n")), "payloads")
    same = stage(keyed.groupBy("sha").agg(F.max("page_id").alias("first"), F.min("page_id").alias("least"),
                                          F.count(F.lit(1)).alias("rows")).filter(F.col("least") < F.col("first")), "same-payloads")
    revisits = (skew_join(keyed, same, ["sha"], keyed.count(), "rows").filter(F.col("page_id") < F.col("first"))
                .select("page_id", F.col("first").alias("refers_to"), F.col("sha").alias("of")).distinct())
    marked = (rows.filter(F.col("page_id").isNotNull()).withColumn("of", F.unhex(F.sha2("html", 256)))
              .join(revisits, ["page_id", "of"], "left").select("page_id", "url", "html", "refers_to"))
    unnamed = rows.filter(F.col("page_id").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    # the list of files is written by Spark, which commits one attempt of each task
    return stage(marked.unionByName(unnamed).mapInArrow(
        _writer(folder, file_bytes), "file string, n_records long, bytes long"), "archive-list")


class _Range:
    """Bytes of a file from a start on, read in blocks."""

    def __init__(self, handle, start: int, size: int):
        self.handle, self.at, self.size = handle, start, size
        self.data = bytearray()

    def fill(self, upto: int) -> bool:
        """Have the bytes before ``upto``, if the file has them."""
        while self.at + len(self.data) < min(upto, self.size):
            self.handle.seek(self.at + len(self.data))
            more = self.handle.read(BLOCK)
            if not more:
                return False
            self.data += more
        return upto <= self.size

    def drop(self, before: int) -> None:
        del self.data[:before - self.at]
        self.at = before


def _starts_record(window: bytes) -> bool:
    """Whether a gzip member that begins here decodes to a WARC version line."""
    try:
        return zlib.decompressobj(31).decompress(window, 16).startswith(b"WARC/")
    except zlib.error:
        return False


def _member(source: _Range, start: int) -> tuple[bytes, int] | None:
    """The decoded member at ``start`` and its end; None if it is cut short or broken."""
    decoder, parts, at = zlib.decompressobj(31), [], start
    while True:
        source.fill(at + BLOCK)
        piece = source.data[at - source.at:at - source.at + BLOCK]
        if not piece:
            return None
        try:
            parts.append(decoder.decompress(piece))
        except zlib.error:
            return None
        at += len(piece)
        if decoder.eof:
            return b"".join(parts), at - len(decoder.unused_data)


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}, rest


def _page_of(record_id: str | None) -> int | None:
    return int(record_id[len("<urn:page:"):-1]) if record_id and record_id.startswith("<urn:page:") else None


def parse_record(raw: bytes) -> dict:
    """Fields of one decoded record, with its payload (None for a revisit)."""
    warc, rest = _headers(raw)
    block = rest[:int(warc.get("content-length", len(rest)))]
    http, payload = _headers(block)
    kind = warc.get("warc-type")
    return {"page_id": _page_of(warc.get("warc-record-id")), "url": warc.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else int(http.get("content-length", 0)),
            "payload_digest": digest(payload) if kind == "response" else warc.get("warc-payload-digest", "").removeprefix("sha1:"),
            "refers_to": _page_of(warc.get("warc-refers-to")), "payload": payload if kind == "response" else None}


def records_in(path: str, start: int, end: int):
    """(position, decoded record) of every record that starts in [start, end) of a file."""
    system, name = _open(path)
    with system.open_input_file(name) as handle:
        size = handle.size()
        source, at = _Range(handle, start, size), start
        while at < min(end, size):
            source.drop(at)
            source.fill(at + BLOCK)
            found = source.data.find(MAGIC)
            if found < 0:
                at += max(1, len(source.data) - len(MAGIC) + 1)
                continue
            at += found
            if at >= end:
                return
            source.fill(at + 4096)
            if not _starts_record(source.data[at - source.at:at - source.at + 4096]) or not (got := _member(source, at)):
                at += 1
                continue
            yield at, got[0]
            at = got[1]


def _reader(with_payload: bool):
    names = [c.split()[0] for c in RECORD_FIELDS.split(", ")] + ["payload"] * with_payload

    def run(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("position", pa.int64()),
                            ("payload", pa.binary())])
        schema = pa.schema([schema.field(n) for n in names])
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                for position, raw in records_in(path, start, end):
                    row = parse_record(raw) | {"file": path, "position": position}
                    rows.append({n: row[n] for n in names})
                    held += len(raw) if with_payload else 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def read_archives(spark: SparkSession, folder: str, files: DataFrame | None = None,
                  split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per record; ``files`` (file, bytes) names the committed files, else all are read."""
    prepare(spark)
    if files is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select(
            F.col("path").alias("file"), F.col("length").alias("bytes"))
    else:
        files = files.select(F.concat(F.lit(folder.rstrip("/") + "/"), "file").alias("file"), "bytes")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = files.select("file", starts.alias("start")).select("file", "start", (F.col("start") + split_bytes).alias("end"))
    ranges = stage(ranges, "archive-ranges")
    return ranges.repartition(max(1, ranges.count())).mapInArrow(  # one range a task
        _reader(with_payload), RECORD_FIELDS + ", payload binary" * with_payload)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the records of all pages, read back from the archives."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = scratch_path(spark, "warc")
    files = write_archives(pages, folder)
    return read_archives(spark, folder, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, html, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex,
         max(page_id) OVER (PARTITION BY html) AS first FROM p),
bits AS (
  SELECT *, [('0x' || hex[i * 10 + 1 : i * 10 + 10])::BIGINT FOR i IN range(0, 4)] AS w FROM d)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((w[(k // 8) + 1] >> (35 - 5 * (k % 8))) & 31)::INTEGER + 1, 1) FOR k IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""
