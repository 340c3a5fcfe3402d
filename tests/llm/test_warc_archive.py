"""Operator 5: round trip of records, and the archive's promises."""

import hashlib

from pyspark.sql import functions as F

from farelane.llm import warc_archive as A
from farelane.session import scratch_path

BIG = "<html>" + "é" * 60 + "</html>"


def _pages(spark):
    rows = [(5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, None, BIG), (None, "http://n", BIG), (None, None, None), (4, "http://a\r\nX: 1", "small"),
            (6, "http://b", "small"), (7, "http://c", ""), (8, "http://c", None), (3, "http://a/3", BIG), (10, "u", BIG + "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit("clash"), "payload": F.lit(1)})


def _brute(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out, used = [], set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (h or "").encode()
        new = len(b) < 100 or (i == first.get(b) and b not in used)
        if len(b) >= 100 and new:
            used.add(b)
        out.append((str(i), len(b), hashlib.sha256(b).hexdigest(), "response" if new else "revisit", None if new else first.get(b), True))
    return sorted(out, key=str)


def test_reads_back_what_was_written(spark):
    path = scratch_path(spark, "warc-test")
    pages = _pages(spark)
    A.write_archive(pages, path)
    got = A.read_archive(spark, path)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.verified) for r in got.collect()), key=str) == _brute(rows)
    # payloads are stored once, and records are whole WARC bytes
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert len(stored) == len({(h or "").encode() for _, _, h in rows}) and all(hashlib.sha256(r.payload).hexdigest() == r.digest for r in stored)
    for r in A.read_records(spark, path).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(head.rpartition(b"Content-Length: ")[2])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[length:] == b"\r\n\r\n" and b"\r\nX: 1" not in head
        assert len(rest) == length + 4


def test_a_damaged_payload_is_not_verified(spark):
    path, bad = scratch_path(spark, "warc-test"), scratch_path(spark, "warc-bad")
    A.write_archive(_pages(spark), path)
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{bad}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{bad}/headers")
    assert {r.verified for r in A.read_archive(spark, bad).collect()} == {False}


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    A.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert A.read_archive(spark, path).count() == 0
