"""Archives: round trip, boundaries, edge rows."""

import base64
import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from tallymark.llm import warc

SCHEMA = "page_id long, url string, html string"
FAKE = "before WARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nbehind"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows):
    """Largest page_id of each html is the response."""
    out, answered = [], set()
    for page, url, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True):
        best = max((r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None), default=None)
        first = (html or "") not in answered
        answered.add(html or "")
        out.append((page, len((html or "").encode()), digest(html), "response" if first else "revisit", None if first else best))
    return sorted(out, key=repr)


def read(spark, path):
    got = warc.read_archive(spark, path).collect()
    assert all(r.intact for r in got)
    number = lambda x: None if x is None else int(x)
    return got, sorted(
        ((number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in got), key=repr
    )


ROWS = [
    (1, "http://a.example/1", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"), (3, "http://a.example/3", None), (4, None, ""),
    (5, "http://a.example/a b\r\nContent-Length: 3", FAKE), (6, "http://a.example/6", FAKE * 3), (7, "x", "é漢\U0001f600\r\n\r\n" * 3),
    (8, "x", "WARC/1.0\r\n"), (9, "x", "WARC/1.0\r\nWARC/1.0\r\n"), (10, "x", "long text " * 50_000 + FAKE), (11, "x", FAKE), (11, "x", FAKE),
    (None, "x", "no id"), (None, "y", "no id"), (12, "x", "\r\n\r\nWARC/1.0"), (13, "x", "ends with WARC/1.0\r"),
]


@pytest.mark.parametrize("split", ["128m", "1000b", "37b"])
def test_round_trip(spark, tmp_path, split):
    """Also where tasks start and end anywhere in records, in the magic bytes too."""
    path = str(tmp_path / "out")
    frame = spark.createDataFrame(ROWS, SCHEMA).select("*", F.lit(1).alias("SIZE"), F.lit("x").alias("sha1")).repartition(3)
    warc.write_archive(frame, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    if split == "37b":  # one short file in many ranges
        path = str(tmp_path / "short")
        warc.write_archive(spark.createDataFrame(ROWS[:9], SCHEMA).coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got, rows = read(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert rows == plain(ROWS[:9] if split == "37b" else ROWS)
    assert len({r.record_id for r in got}) == len(got)


def test_files_hold_the_records_at_their_offsets(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archive(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), path)
    contents = {f: open(f, "rb").read() for f in glob.glob(path + "/part-*") }
    for r in warc.read_archive(spark, path).collect():
        data = contents[r.file.removeprefix("file://").replace("file:", "")]
        assert data[r.at :].startswith(b"WARC/1.0\r\nWARC-Type: " + r.record_type.encode())
    assert all(not data or data.endswith(b"\r\n\r\n") for data in contents.values())


def test_foreign_bytes_and_empty_tables(spark, tmp_path):
    empty = str(tmp_path / "empty")
    warc.write_archive(spark.createDataFrame([], SCHEMA), empty)
    assert warc.read_archive(spark, empty).collect() == []
    other = tmp_path / "other"
    other.mkdir()
    (other / "part-0").write_bytes(b"not an archive\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    assert warc.read_archive(spark, str(other)).collect() == []


def test_digest_is_base32(spark):
    got = spark.createDataFrame([("",), ("abc",)], "t string").select("t", warc.base32(F.sha1(F.col("t").cast("binary"))).alias("d")).collect()
    assert all(r.d == digest(r.t) for r in got)
