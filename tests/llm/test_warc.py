"""WARC archives: round trips, one member a record, revisits."""

import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from shopmetrics.llm import op13_warc as W
from tests.conftest import SF_SMALL


def brute(rows: list[tuple]) -> list[tuple]:
    top: dict = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", i))
    out = []
    for i, _, h in rows:
        body, to = (h or "").encode(), top.get(h or "")
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), sha, "response" if i == to else "revisit", None if i == to else to))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [(1, "http://a/x y\r\nEvil: 1", "<p>same</p>"), (5, None, "<p>same</p>"), (3, "http://ü/", "<p>same</p>"), (2, "u", None), (4, "u", ""),
        (6, "u", "é\r\n\r\nWARC/1.1\r\n" * 50), (None, "u", "<p>same</p>"), (None, "u", "alone"), (7, "v", "twice"), (7, "v", "twice"), (8, "long", "x" * 3_000_000)]


def test_round_trip_equals_brute_force(spark, tmp_dir):
    schema = "page_id long, url string, html string, id int, payload int, archive string, refers_to int"
    spark.createDataFrame([(*r, 1, 2, "a", 3) for r in ROWS], schema).write.parquet(f"{tmp_dir}/pages.parquet")
    assert result(W.op13_warc(spark, tmp_dir)) == brute(ROWS)


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert result(W.op13_warc(spark, SF_SMALL)) == brute(rows)


def test_empty_table(spark, tmp_dir):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_dir}/pages.parquet")
    assert result(W.op13_warc(spark, tmp_dir)) == []


def test_files_on_disk(spark, tmp_dir, monkeypatch):
    """Every member opens alone at its offset; archives read whole hold all payloads once."""
    monkeypatch.setattr(W, "ARCHIVE_RECORDS", 3)
    rows = spark.createDataFrame(ROWS, "id long, url string, payload string").coalesce(1).withColumn("id", F.col("id").cast("string"))
    written = W.write_archives(rows, f"file://{tmp_dir}/mono")
    assert written.select("archive").distinct().count() == 4
    decided = W.decide(written, "long")
    index = W.normalise(decided, f"file://{tmp_dir}/warc").orderBy("archive", "offset").collect()
    assert len(index) == len(ROWS)
    archives: dict = {}
    for r in index:
        archives.setdefault(r["archive"].removeprefix("file://"), []).append(r)
    for path, rs in archives.items():
        data, at = open(path, "rb").read(), 0
        for r in rs:
            assert r["offset"] == at  # members follow each other without a gap
            one = zlib.decompressobj(31)
            text = one.decompress(data[at:at + r["length"]])
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            assert f"WARC-Type: {r['record_type']}".encode() in text and b"\r\nEvil:" not in text.split(b"\r\n\r\n")[0]
            at += r["length"]
        assert at == len(data) and len(open(path + ".idx").read().splitlines()) == len(rs)
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(rs)


def test_least_bytes_keeps_small_payloads(spark, tmp_dir):
    rows = spark.createDataFrame(ROWS, "id long, url string, payload string").withColumn("id", F.col("id").cast("string"))
    decided = W.decide(W.write_archives(rows, f"file://{tmp_dir}/mono"), "long", least_bytes=100)
    assert decided.filter("refers_to is not null").count() == 0


def test_foreign_stream_and_damage():
    """A whole-file stream of another writer: other header case, several members, a damaged record."""
    record = b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:a>\r\ncontent-length: 5\r\n\r\nhello\r\n\r\n"
    out = io.BytesIO()
    rows = list(W.rewrite(io.BytesIO(gzip.compress(record * 2) + gzip.compress(record)), out))
    assert [r["record_type"] for r in rows] == ["resource"] * 3 and gzip.decompress(out.getvalue()[rows[1]["offset"]:][:rows[1]["length"]]).endswith(b"hello\r\n\r\n")
    with pytest.raises(ValueError, match="blank lines"):
        list(W.rewrite(io.BytesIO(gzip.compress(record.replace(b"5", b"4"))), io.BytesIO()))
    with pytest.raises(ValueError, match="shorter"):
        list(W.rewrite(io.BytesIO(gzip.compress(record[:-7])), io.BytesIO()))
