"""WARC archives: a writer and a splittable reader.

Writer.  One gzip member per record (a ``warcinfo`` record first in each file).
Of records with equal payloads of at least ``min_revisit_bytes`` bytes the one
with the smallest page id is a ``response``, the others are ``revisit`` records
that name it and carry no payload.  Every attempt of a task writes archives under
names of its own and returns them as rows of the folder's manifest, a table that
Spark commits with one attempt per task.  The reader opens what the manifest
lists; archives of lost or repeated attempts are not in it and are deleted.  A
folder that is written again holds, by its manifest, the last write.

Reader.  Files are cut into byte ranges.  A task looks for the gzip magic in its
range, takes a candidate as a member if it inflates to a WARC header, and owns
the records that start inside its range, reading past the end to finish the
last.  Magic bytes inside compressed data fail that test and are passed over.

A folder without a manifest (archives from elsewhere) is read by its listing.
Folders are named by URI and opened through ``pyarrow.fs`` in the tasks, so any
shared store that it knows will do.

Defined cases: a null page text has an empty payload (and equal empty payloads
revisit the first as any others do); rows repeated under the smallest page id
are all responses and, being the same capture, share a record id (it is made of
page id and payload digest); a null page id is never the smallest, and a group
without any id has responses only; a null URL is written as ``urn:page:<id>``; empty
tables give archives without records and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feescope.llm.common import ship_code
from feescope.session import make_folder, materialize, path_exists, scratch_path

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 1 << 30
SPLIT_BYTES = 32 << 20
MANIFEST = "_manifest/archives"
MANIFEST_SCHEMA = "name string, length long, records long"
SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")


# ---------------------------------------------------------------- records

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'urn:page:{page_id}:{digest}')}>"


def _one_line(value: str) -> str:
    """The value with white space and control characters percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" and not c.isspace() else
                   "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    digest = digest_of(payload)
    fields = [("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
              ("WARC-Target-URI", _one_line(url) if url else f"urn:page:{page_id}"),
              ("WARC-Payload-Digest", "sha1:" + digest),
              ("Content-Type", "application/http;msgtype=response"),
              ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is None:
        return record("response", fields, http.encode() + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
               ("X-Refers-To-Page-ID", str(refers_to))]
    return record("revisit", fields, http.encode())


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of one inflated record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is not that of its header")
    return fields, rest[:n]


# ---------------------------------------------------------------- writer

class _Files:
    """The archives of one attempt of a task, under names that no other attempt uses."""

    def __init__(self, folder: str, prefix: str, file_bytes: int, date: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.prefix, self.limit, self.date = prefix, file_bytes, date
        self.out, self.size, self.records = None, 0, 0
        self.done: list[tuple[str, int, int]] = []

    def put(self, raw: bytes, level: int) -> None:
        if self.out is None:
            self.name = f"{self.prefix}-{len(self.done):05d}.warc.gz"
            self.out, self.size, self.records = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None), 0, 0
            info = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"), ("WARC-Date", self.date),
                    ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._member(record("warcinfo", info, b"format: WARC File Format 1.1\r\n"), level)
        self._member(raw, level)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def _member(self, raw: bytes, level: int) -> None:
        data = gzip.compress(raw, level, mtime=0)
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.size, self.records))
            self.out = None


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of every archive below ``folder``, by its listing."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
            .load(folder).select("path", "length"))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/{MANIFEST}")


def _drop_strays(spark: SparkSession, folder: str, token: str) -> None:
    """Delete the archives of the write ``token`` that its manifest doesn't list."""
    name = F.element_at(F.split("path", "/"), -1)
    strays = _archives(spark, folder).withColumn("name", name).where(F.col("name").startswith(f"part-{token}-")).join(
        _manifest(spark, folder), "name", "left_anti").select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, p = pafs.FileSystem.from_uri(path)
                if fs.get_file_info(p).is_file:  # a repeated task finds it gone
                    fs.delete_file(p)
            yield b

    strays.mapInArrow(run, "path string").count()


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, date: str = DATE, level: int = 4,
               file_bytes: int = FILE_BYTES) -> int:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the number of pages' records.

    Payload digests are grouped (partial sums first, so a payload that a third
    of all pages share is one row per task), and only digests that occur twice
    are joined back; that join's large partitions can be split.
    """
    ship_code(pages.sparkSession)
    make_folder(pages.sparkSession, folder)  # there even if no page is written
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("sha", F.sha1("payload"))
    first = p.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    p = p.join(materialize(first, "warc-first"), "sha", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))

    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files = _Files(folder, f"part-{token}-{task.partitionId():05d}-{task.taskAttemptId()}", file_bytes, date)
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(c for c in b.columns)):
                files.put(page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), date), level)
        files.close()
        names, lengths, records = zip(*files.done) if files.done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(lengths, pa.int64()), pa.array(records, pa.int64())],
            names=["name", "length", "records"])

    p.mapInArrow(run, MANIFEST_SCHEMA).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")
    _drop_strays(pages.sparkSession, folder, token)
    return _manifest(pages.sparkSession, folder).agg(F.sum("records")).first()[0] or 0


# ---------------------------------------------------------------- splittable reader

class _Window:
    """Random reads of one file through a buffer."""

    def __init__(self, f, size: int, chunk: int = 4 << 20):
        self.f, self.size, self.chunk, self.lo, self.data = f, size, chunk, 0, b""

    def at(self, pos: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``pos``."""
        if pos < self.lo or pos + n > self.lo + len(self.data):
            self.lo = pos
            self.data = self.f.read_at(min(max(n, self.chunk), max(0, self.size - pos)), pos)
        return self.data[pos - self.lo:pos - self.lo + n]


def _is_member(w: _Window, pos: int) -> bool:
    """Whether a gzip member at ``pos`` inflates to a WARC header."""
    d = zlib.decompressobj(31)
    try:
        got = d.decompress(w.at(pos, 4096), 4096)
    except zlib.error:
        return False
    return got.startswith(b"WARC/1.") and b"\r\nWARC-" in got


def _inflate(w: _Window, pos: int) -> tuple[bytes, int]:
    """(content, end) of the member at ``pos``."""
    d, parts = zlib.decompressobj(31), []
    while not d.eof:
        data = w.at(pos, 64 << 10)
        if not data:
            raise ValueError("an archive ends inside a record")
        parts.append(d.decompress(data))
        pos += len(data) - len(d.unused_data)
    return b"".join(parts), pos


def members(f, size: int, lo: int, hi: int) -> Iterator[bytes]:
    """The inflated records that start in [lo, hi)."""
    w, pos = _Window(f, size), lo
    while pos < hi:
        if w.at(pos, 3) == MAGIC and _is_member(w, pos):
            raw, pos = _inflate(w, pos)
            yield raw
            continue
        block = w.at(pos + 1, min(w.chunk, hi + 1 - pos))  # up to two bytes past the last place for a start
        k = block.find(MAGIC)
        pos = pos + 1 + k if k >= 0 else pos + max(1, len(block) - 1)


def _row(raw: bytes, payloads: bool) -> tuple | None:
    fields, block = parse_record(raw)
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload, n = None, int(fields["X-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if digest_of(payload) != digest or len(payload) != n:
            raise ValueError(f"record {fields['WARC-Record-ID']}: the payload is not that of its digest")
    page_id, refers_to = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return (page_id and int(page_id), fields["WARC-Target-URI"], kind, n, digest,
            refers_to and int(refers_to), payload if payloads else None)


def _read(payloads: bool):
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, lo, hi in zip(*(c.to_pylist() for c in b.columns)):
                fs, p = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(p) as f:
                    for raw in members(f, size, lo, min(hi, size)):
                        if row := _row(raw, payloads):
                            rows.append(row)
                            held += len(row[6] or b"") + 200
                        if held > 16 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)
    return run


def read_warc(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, payloads: bool = False) -> DataFrame:
    """The response and revisit records below ``folder``: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to (and payload, if asked for)."""
    ship_code(spark)
    if path_exists(spark, f"{folder}/{MANIFEST}"):
        files = _manifest(spark, folder).select(F.concat(F.lit(f"{folder}/"), "name").alias("path"), "length")
    else:
        files = _archives(spark, folder)
    files = files.where("length > 0")
    splits = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("lo"))
    n = splits.count()  # from the names and lengths alone
    splits = splits.withColumn("hi", F.col("lo") + split_bytes).repartition(max(1, n))
    return splits.mapInArrow(_read(payloads), SCHEMA)


def warc_round_trip(pages: DataFrame, min_revisit_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: one row per page."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_warc(pages, folder, min_revisit_bytes)
    return read_warc(spark, folder, split_bytes).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
