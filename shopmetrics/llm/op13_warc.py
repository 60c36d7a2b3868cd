"""WARC archives: write, normalise from one gzip stream to one member a record, read by offset.

1. ``write_archives`` lays rows down as WARC/1.1 response records.  Each task rolls over files
   that are one gzip stream from end to end (monolithic) and returns where each record went
   and the SHA-256 of its payload.
2. ``decide`` picks, for every payload, the row with the largest id; all others revisit it.
   Only hashes and ids are shuffled, never a payload.
3. ``normalise`` is one task's work for each archive: the stream is inflated once, front to
   back, and every record is written again as a gzip member of its own, revisits without
   their payload.  Offsets, lengths, types and digests go to a sidecar index beside the new
   archive, and to a table.
4. ``read_records`` reads members by offset from that index.  Digests of responses are
   computed anew and must agree with their headers.

Files are reached through ``pyarrow.fs``, in the shared folder that Spark names.  A file's
name holds a random part, and only names that a finished task returned are read, so a lost
executor leaves at most unread files.  Records are copied in pieces: memory does not grow with
a record (beyond the row that Spark hands over) or an archive.  An archive holds at most
``ARCHIVE_RECORDS`` records, the size of one group.

Defined cases: a null payload is empty; a null url gives no target header, control characters
and blanks in one are percent-encoded; null ids sort below all others, and of a payload with
null ids only, every record is a response; rows that share a payload's largest id are all
responses; repeated rows are repeated records; payloads below ``least_bytes`` are responses;
an empty table writes no archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.session import scratch_path

from . import common as C

ARCHIVE_BYTES = 64 << 20
ARCHIVE_RECORDS = 50_000
#: Members of one archive are read by so many tasks at most as this goes into its length.
READ_BYTES = 8 << 20
PIECE = 1 << 20
MAX_TASKS = 50_000
DATE = "1970-01-01T00:00:00Z"  # the tables have no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "archive string, seq int, id string, bytes long, payload binary"
INDEX = "archive string, offset long, length long, record_id string, record_type string, digest string"
RECORD = "id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string"


# ---- records ---------------------------------------------------------------------------
def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def urn(page: str | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def page_of(record_id: str | None) -> str | None:
    return None if record_id is None else record_id[len("<urn:x-page:"):-1] or None


def clean_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def http_header(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def read_header(stream: BinaryIO) -> tuple[bytes, list[tuple[str, str]]] | None:
    """(bytes, fields) up to the blank line, which is included; None at the end of the stream."""
    raw, fields = stream.readline(), []
    if not raw:
        return None
    while True:
        line = stream.readline()
        raw += line
        if line in (b"\r\n", b"\n"):
            return raw, fields
        if not line:
            raise ValueError("header without end")
        name, _, value = line.decode("utf-8").partition(":")
        fields.append((name.strip(), value.strip()))


def field(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


def pieces(stream: BinaryIO, size: int) -> Iterator[bytes]:
    while size:
        piece = stream.read(min(size, PIECE))
        if not piece:
            raise ValueError("record shorter than its Content-Length")
        size -= len(piece)
        yield piece


# ---- 1. monolithic archives ---------------------------------------------------------------
def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes (id, url, payload) rows; (archive, seq, id, bytes, payload hash) of each."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, held, seq, done = None, "", 0, 0, []

        def closed() -> pa.RecordBatch:
            out[0].write(out[1].flush())
            out[0].close()
            return pa.RecordBatch.from_pylist(done, schema=pa.schema([
                ("archive", pa.string()), ("seq", pa.int32()), ("id", pa.string()), ("bytes", pa.int64()), ("payload", pa.binary())]))

        for b in batches:
            for i in range(b.num_rows):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = (files.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31))
                    held, seq, done = 0, 0, []
                page, url = b.column("id")[i].as_py(), b.column("url")[i].as_py()
                payload = b.column("payload")[i].as_buffer() or b""
                size, http = len(payload), http_header(len(payload))
                head = [("WARC-Type", "response"), ("WARC-Record-ID", urn(page)), ("WARC-Date", DATE),
                        *([] if url is None else [("WARC-Target-URI", clean_url(url))]),
                        ("WARC-Payload-Digest", "sha1:" + sha1_base32(hashlib.sha1(payload).digest())),
                        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + size))]
                for part in (header(head), http, payload, b"\r\n\r\n"):
                    out[0].write(out[1].compress(part))
                done.append({"archive": f"{folder}/{name}", "seq": seq, "id": page, "bytes": size, "payload": hashlib.sha256(payload).digest()})
                seq, held = seq + 1, held + size
                if held >= ARCHIVE_BYTES or seq >= ARCHIVE_RECORDS:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return C.materialize(rows.select("id", "url", F.coalesce("payload", F.lit("")).alias("payload")).mapInArrow(write, WRITTEN), "warc-written")


# ---- 2. responses and revisits --------------------------------------------------------------
def decide(written: DataFrame, id_type: str, least_bytes: int = 0) -> DataFrame:
    """(archive, seq, refers_to): the id that a record revisits, null for a response."""
    number = F.col("id").cast(id_type)
    # written: one row a payload, against which Spark can split the copies of a hot one
    tops = C.materialize(written.filter(F.col("bytes") >= least_bytes).groupBy(F.col("payload").alias("t_payload"))
                         .agg(F.max(number).alias("top")), "warc-payloads")
    return written.join(tops, F.col("payload") == F.col("t_payload"), "left").select(
        "archive", "seq", F.when(~number.eqNullSafe(F.col("top")), F.col("top").cast("string")).alias("refers_to"))


# ---- 3. one member a record -----------------------------------------------------------------
def rewrite(source: BinaryIO, target: BinaryIO, refers: list[str | None] | None = None) -> Iterator[dict]:
    """Copies every record of the gzip stream ``source`` to ``target`` as its own member.

    Record i becomes a revisit of ``refers[i]`` where that is given.  Yields index rows.
    """
    stream, seq = io.BufferedReader(gzip.GzipFile(fileobj=source), PIECE), 0
    while (head := read_header(stream)) is not None:
        fields, size = head[1], int(field(head[1], "Content-Length"))
        to = refers[seq] if refers else None
        if to is None:
            body = pieces(stream, size)
        else:
            http = read_header(stream)[0]
            for _ in pieces(stream, size - len(http)):
                pass  # the payload of a revisit is left out
            changed = {"warc-type": "revisit", "content-length": str(len(http))}
            fields = [(k, changed.get(k.lower(), v)) for k, v in fields] + [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(to))]
            body = iter([http])
        offset, gz = target.tell(), zlib.compressobj(6, zlib.DEFLATED, 31)
        target.write(gz.compress(header(fields)))
        for piece in body:
            target.write(gz.compress(piece))
        target.write(gz.compress(b"\r\n\r\n") + gz.flush())
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record without its closing blank lines")
        yield {"offset": offset, "length": target.tell() - offset, "record_id": field(fields, "WARC-Record-ID"),
               "record_type": field(fields, "WARC-Type"), "digest": field(fields, "WARC-Payload-Digest")}
        seq += 1


def _normaliser(folder: str) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("record_id", pa.string()), ("record_type", pa.string()), ("digest", pa.string())])

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        archive = table.column("archive")[0].as_py()
        files, path = fs.FileSystem.from_uri(archive)
        home, root = fs.FileSystem.from_uri(folder)
        home.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        refers = table.column("refers_to").to_pylist()
        with files.open_input_stream(path, compression=None) as source, home.open_output_stream(f"{root}/{name}", compression=None) as target:
            rows = [{"archive": f"{folder}/{name}", **r} for r in rewrite(source, target, refers if any(r is not None for r in refers) else None)]
        with home.open_output_stream(f"{root}/{name}.idx", compression=None) as sidecar:
            sidecar.write("".join(f"{r['offset']} {r['length']} {r['record_type']} {r['record_id']} {r['digest']}\n" for r in rows).encode())
        return pa.Table.from_pylist(rows, schema=schema)
    return one


def normalise(records: DataFrame, folder: str) -> DataFrame:
    """Index rows of the archives of ``records`` (archive, seq, refers_to), rewritten in ``folder``."""
    # as many tasks as archives: their index rows are few, their files are not
    tasks = min(MAX_TASKS, max(1, records.select("archive").distinct().count()))
    rows = records.select("archive", "seq", "refers_to").repartition(tasks, "archive")
    return C.materialize(rows.groupBy("archive").applyInArrow(_normaliser(folder), INDEX), "warc-index")


# ---- 4. reading by offset ----------------------------------------------------------------------
class _Member(io.RawIOBase):
    """The ``length`` bytes at ``offset`` of a file."""

    def __init__(self, file: pa.NativeFile, offset: int, length: int):
        file.seek(offset)
        self.file, self.left = file, length

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.file.read(min(len(into), self.left))
        into[:len(data)] = data
        self.left -= len(data)
        return len(data)


def read_member(file: pa.NativeFile, offset: int, length: int) -> dict:
    """The record of one member; a response's payload is hashed and compared with its header."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BufferedReader(_Member(file, offset, length), PIECE)), PIECE)
    _, fields = read_header(stream)
    size, kind = int(field(fields, "Content-Length")), field(fields, "WARC-Type")
    http, http_fields = read_header(stream)
    digest = field(fields, "WARC-Payload-Digest").removeprefix("sha1:")
    n_bytes = int(field(http_fields, "Content-Length"))
    if kind == "response":
        sha, n_bytes = hashlib.sha1(), size - len(http)
        for piece in pieces(stream, n_bytes):
            sha.update(piece)
        if sha1_base32(sha.digest()) != digest:
            raise ValueError(f"payload of {field(fields, 'WARC-Record-ID')} does not have its digest")
    return {"id": page_of(field(fields, "WARC-Record-ID")), "payload_bytes": n_bytes, "payload_digest": digest, "record_type": kind,
            "refers_to": page_of(field(fields, "WARC-Refers-To")), "url": field(fields, "WARC-Target-URI")}


def read_records(index: DataFrame) -> DataFrame:
    """Every record that ``index`` names, read from the archives member by member."""
    schema = pa.schema([("id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    if file is not None:
                        file.close()
                    files, path = fs.FileSystem.from_uri(archive)
                    name, file = archive, files.open_input_file(path)
                rows.append(read_member(file, offset, length))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    part = F.floor(F.col("offset") / READ_BYTES)
    tasks = min(MAX_TASKS, max(1, index.select("archive", part).distinct().count()))
    runs = index.select("archive", "offset", "length").repartition(tasks, "archive", part).sortWithinPartitions("archive", "offset")
    return runs.mapInArrow(read, RECORD)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages")
    rows = pages.select(F.col("page_id").cast("string").alias("id"), "url", F.col("html").alias("payload"))
    written = write_archives(rows, scratch_path(spark, "warc-monolithic"))
    index = normalise(decide(written, "long"), scratch_path(spark, "warc"))
    return read_records(index).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM x"""
