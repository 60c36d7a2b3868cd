"""Quoted CSV read in byte ranges.

A quoted field may hold line breaks, so a line that begins inside a byte range may or
may not begin a record; Spark's ``multiLine`` option therefore reads a file as one task.
Here a file is cut into ranges of ``spark.sql.files.maxPartitionBytes`` and read twice:

1. Every range works out what its lines do to the two states a line can begin in (at a
   record, or inside a quoted field): the pair of states they lead to.  Such a pair keeps,
   swaps or fixes the state, so the state at the start of each range follows from a running
   count of the swaps since the last fixed one, a window over one small row a range.
2. Every range emits the records that begin in it, reading on past its end until the last
   one closes.  Spark's ``from_csv`` then parses each record by the declared schema.

The rules are those of the Spark reader: a quote opens a field only as its first character,
a doubled quote inside is a quote, text after the closing quote runs to the next comma.

Defined cases: empty records are skipped; the first record of every file is its header;
bytes that are not UTF-8 become U+FFFD; an unclosed quote runs to the end of its file; a
compressed file is one range.  A task holds one record and a buffer of ``CHUNK`` bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 4 << 20
BATCH_RECORDS = 4096
BATCH_BYTES = 8 << 20
COMPRESSED = r"\.(gz|bz2|zst|lz4)$"

RECORD = "file string, row long, value string"

# One field from its first character: quoted and closed, or unquoted.
_FIELD = rb'(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+)'
_REST = rb"(?:," + _FIELD + rb")*+\Z"
_WITH_QUOTE = re.compile(rb'(?m)^[^\n"]*+"[^\n]*+')
_CLOSED_FROM = (re.compile(_FIELD + _REST), re.compile(rb'(?:[^"]|"")*+"[^,]*+' + _REST))


def _inside_after(line: bytes, inside: int) -> int:
    """1 if the line, begun inside (1) or outside (0) a quoted field, ends inside one."""
    if b'"' not in line:
        return inside
    return 0 if _CLOSED_FROM[inside].match(line) else 1


def _open(path: str):
    """A seekable stream of an uncompressed file, or the plain bytes of a compressed one."""
    if path.startswith("file:"):
        system, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    elif "://" not in path:
        system, name = fs.LocalFileSystem(), path
    else:
        system, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    if re.search(COMPRESSED, path):
        return system.open_input_stream(name, compression="detect")
    return system.open_input_file(name)


def _blocks(stream, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, whole lines) from the first line that begins in [start, end) to the end of the file."""
    at, skipping = start, start > 0
    if skipping:
        at = start - 1
        stream.seek(at)
    held = bytearray()
    while chunk := stream.read(CHUNK):
        if skipping:
            found = chunk.find(b"\n")
            at += len(chunk) if found < 0 else found + 1
            if at >= end:
                return
            if found < 0:
                continue
            skipping, chunk = False, chunk[found + 1:]
        held += chunk
        cut = held.rfind(b"\n", len(held) - len(chunk))
        if cut < 0:
            continue
        yield at, bytes(held[:cut])
        at += cut + 1
        del held[:cut + 1]
    if held and not skipping:
        yield at, bytes(held)


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: the states its lines lead to from outside and from inside."""
    for batch in batches:
        for r in batch.to_pylist():
            outside, inside = 0, 1
            with _open(r["file"]) as stream:
                for at, block in _blocks(stream, r["start"], r["end"]):
                    if at >= r["end"]:
                        break
                    for found in _WITH_QUOTE.finditer(block):
                        if at + found.start() >= r["end"]:
                            break
                        same = outside == inside
                        outside = _inside_after(found[0], outside)
                        inside = outside if same else _inside_after(found[0], inside)
            yield pa.RecordBatch.from_pylist([{**r, "outside": outside, "inside": inside}], schema=pa.schema(
                [("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                 ("outside", pa.int32()), ("inside", pa.int32())]))


def _range_records(r: dict) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the records that begin in the range, the header left out."""
    state, held, began, header, end = r["entry"], None, 0, r["start"] == 0, r["end"]
    with _open(r["file"]) as stream:
        for at, block in _blocks(stream, r["start"], end):
            for line in block.split(b"\n"):
                if held is None and at >= end:
                    return
                if state == 0:
                    held, began = [], at
                if held is not None:
                    held.append(line)
                at += len(line) + 1
                state = _inside_after(line, state)
                if state == 0 and held is not None:
                    record, held = (b"\n".join(held) if len(held) > 1 else line).removesuffix(b"\r"), None
                    if record and not header:
                        yield began, record
                    header = header and not record
        if held and not header:
            yield began, b"\n".join(held)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "row", "value"]

    def batch_of(file: str, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([file] * len(rows), pa.string()), pa.array([at for at, _ in rows], pa.int64()),
            pa.array([text.decode("utf-8", "replace") for _, text in rows], pa.string())], names)

    for batch in batches:
        for r in batch.to_pylist():
            rows, size = [], 0
            for row in _range_records(r):
                rows.append(row)
                size += len(row[1])
                if len(rows) == BATCH_RECORDS or size >= BATCH_BYTES:
                    yield batch_of(r["file"], rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(r["file"], rows)


def _with_entry(states: DataFrame) -> DataFrame:
    """The ranges with ``entry``, the state at their first line, from the ranges before them in their file."""
    by_file = Window.partitionBy("file").orderBy("start")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("outside") > F.col("inside")).cast("int"))
    # swaps up to and with a fixed range are taken off again: only those after it count
    fixed = F.when(F.col("outside") == F.col("inside"), F.col("outside") - F.col("upto"))
    counted = states.withColumn("upto", swaps.over(by_file.rowsBetween(Window.unboundedPreceding, 0)))
    state = (F.coalesce(swaps.over(before), F.lit(0)) + F.coalesce(F.last(fixed, ignorenulls=True).over(before), F.lit(0)))
    return counted.select("file", "start", "end", F.pmod(state, F.lit(2)).cast("int").alias("entry"))


def _byte_size(text: str) -> int:
    """Bytes of a size setting, such as 134217728b, 16m or 1gb."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def byte_ranges(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(file, start, end, held) of the ranges of ``size`` bytes of a CSV file or a folder of part files."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.col("path").alias("file"), "length").where("length > 0"))
    whole = F.col("file").rlike(COMPRESSED)
    cut = files.select("file", "length", whole.alias("whole"), F.explode(F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))).alias("start"))
    held = F.least(F.col("length") - F.col("start"), F.when(~F.col("whole"), F.lit(size)))
    return cut.select("file", "start", F.when(F.col("whole"), F.lit((1 << 63) - 1)).otherwise(
        F.col("start") + size).cast("long").alias("end"), held.alias("held"))


def read_records(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """Every record as text: ``file``, ``row`` (its byte offset in the file) and ``value``."""
    size = range_bytes or _byte_size(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    ranges = byte_ranges(spark, path, size)
    opening = min(size, _byte_size(spark.conf.get("spark.sql.files.openCostInBytes")))
    # as many tasks as Spark's own scan would plan; a stated number keeps AQE from merging these small rows
    load = ranges.agg(F.sum(F.greatest("held", F.lit(opening)))).first()[0] or 0
    tasks = max(1, -(-load // size))
    states = (ranges.drop("held").repartition(tasks)
              .mapInArrow(_transitions, "file string, start long, end long, outside int, inside int"))
    return _with_entry(states).repartition(tasks).mapInArrow(_records, RECORD)


def parse_records(records: DataFrame, schema: T.StructType, corrupt: str) -> DataFrame:
    """``file``, ``row``, the columns of ``schema`` and ``corrupt``, the text of a record that does not fit it."""
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parsed = F.from_csv("value", ddl, {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "columnNameOfCorruptRecord": corrupt})
    return records.select("file", "row", parsed.alias("r")).select("file", "row", "r.*")
