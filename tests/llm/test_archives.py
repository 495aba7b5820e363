"""ARC and WARC archives: parsing, conversion, round trips."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from mailweave.llm import arc_warc


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _roundtrip(spark, tmp_path, rows, revisit_from=0, partitions=3):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(partitions)
    df = df.withColumn("payload", F.lit("mine")).withColumn("key", F.lit(1))
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    arc_warc.write_arc(df, arc)
    arc_warc.convert(spark, arc, warc, revisit_from)
    return arc_warc.read_warc(spark, warc)


def _contract(records):
    out = []
    for r in records.where("type <> 'warcinfo'").collect():
        page = arc_warc.header_number(F.lit(bytes(r.head)), arc_warc.PAGE_HEADER)
        size = arc_warc.header_number(F.lit(bytes(r.head)), "Content-Length")
        out.append((r, page, size))
    return out


ROWS = [
    (1, "http://a/ b", "<p>x</p>\r\n\r\nWARC/1.0\r\n"),
    (2, None, "same\n"),
    (3, "http://c", "same\n"),
    (9, "http://d", "same\n"),
    (4, "http://e", None),
    (5, "http://f", ""),
    (6, "http://ü/漢", "漢\x00字 filedesc://x 1 2 3 4"),
    (None, "http://g", "same\n"),
    (7, "http://h", "\n\n\n"),
    (8, "http://i", "x" * 200_000),
]


@pytest.mark.parametrize("revisit_from", [0, 6])
def test_roundtrip(spark, tmp_path, revisit_from):
    records = _roundtrip(spark, tmp_path, ROWS, revisit_from)
    found = records.where("type <> 'warcinfo'").select(
        arc_warc.header_number(F.col("head"), arc_warc.PAGE_HEADER).alias("page"),
        arc_warc.header_number(F.col("head"), "Content-Length").alias("size"),
        "payload_digest", "type", "refers_to_page", "payload", "record_id", "refers_to_id", "date",
    ).collect()
    assert len(found) == len(ROWS)
    by_page = {r.page: r for r in found}
    for page, _, html in ROWS:
        data = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "").encode() == data]
        winner = max(p for p in same if p is not None)
        r = by_page[page]
        assert (r.size, r.payload_digest) == (len(data), f"sha1:{_digest(data)}")
        if page == winner or len(data) < revisit_from:
            assert r.type == "response" and bytes(r.payload) == data and r.refers_to_page is None
        else:
            assert r.type == "revisit" and bytes(r.payload) == b""
            assert r.refers_to_page == str(winner) and r.refers_to_id == by_page[winner].record_id
        assert r.date == "2001-01-01T00:00:00Z"
    assert len({r.record_id for r in found}) == len(found)


def test_repeated_and_empty_tables(spark, tmp_path):
    records = _roundtrip(spark, tmp_path / "a", [(1, "u", "h")] * 5, partitions=2)
    types = sorted(r.type for r in records.where("type <> 'warcinfo'").collect())
    assert types == ["response"] + ["revisit"] * 4
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    arc_warc.write_arc(empty, str(tmp_path / "arc"))
    arc_warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    assert arc_warc.read_warc(spark, str(tmp_path / "warc")).where("type <> 'warcinfo'").count() == 0


def _arc(version, *records):
    about = f"{version} 0 someone\n{arc_warc.ARC_FIELDS[version]}\n"
    more = "" if version == 1 else "200 - - 0 f.arc "
    head = f"filedesc://f.arc 0.0.0.0 19970101 text/plain {more}{len(about)}\n"
    return (head + about).encode() + b"".join(b"\n" + r for r in records)


@pytest.mark.parametrize("version", [1, 2])
def test_old_archives(spark, tmp_path, version):
    more = "" if version == 1 else "404 CHECK http://moved 77 f.arc "
    web = b"HTTP/1.0 200 OK\r\nServer: s\r\n\r\n<a>\nb</a>"
    dns = b"19970102030405\nhost. 1 IN A 1.2.3.4\n"
    records = [
        f"http://x/a b 1.2.3.4 19970102030405 text/html {more}{len(web)}\n".encode() + web,
        f"dns:host 1.2.3.4 199701 text/dns {more}{len(dns)}\n".encode() + dns,
        f"http://empty 1.2.3.4 1997 text/html {more}0\n".encode(),
        f"http://x/c 1.2.3.4 19980102030405 text/html {more}{len(web)}\n".encode() + web + b"\n",
    ]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "f.arc.gz").write_bytes(gzip.compress(_arc(version, *records)))
    arc_warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    found = {
        (r.target_uri, r.type, r.date, bytes(r.payload))
        for r in arc_warc.read_warc(spark, str(tmp_path / "warc")).where("type <> 'warcinfo'").collect()
    }
    assert ("dns:host", "resource", "1997-01-01T00:00:00Z", dns) in found
    assert ("http://empty", "resource", "1997-01-01T00:00:00Z", b"") in found
    assert len(found) == 4 and sorted(f[1] for f in found if f[0].startswith("http://x")) == ["response", "revisit"]


@pytest.mark.parametrize(
    "data",
    [
        b"http://x 1.2.3.4 1997 text/html 3\nabc\n",
        _arc(1, b"http://x 1.2.3.4 1997 text/html 9\nabc\n"),
        _arc(1, b"http://x 1.2.3.4 1997 text/html 1\nabc\n"),
        _arc(1, b"http://x 1.2.3.4 1997 text/html many\nabc\n"),
    ],
)
def test_malformed_archives_are_errors(spark, tmp_path, data):
    (tmp_path / "f.arc.gz").write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match="ValueError"):
        arc_warc.read_arc(spark, str(tmp_path)).collect()


def test_split_archives_are_errors(spark, tmp_path):
    (tmp_path / "f.arc").write_bytes(_arc(1, b"http://x 1.2.3.4 1997 text/html 3\nabc\n") + b"\n" * 5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        with pytest.raises(Exception, match="was split"):
            arc_warc.read_arc(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_timestamps():
    assert arc_warc.timestamp("19970102030405") == "1997-01-02T03:04:05Z"
    assert arc_warc.timestamp("1997") == "1997-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        arc_warc.timestamp("97")
