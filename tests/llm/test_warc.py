"""WARC archives: round trips, byte ranges and damaged or misleading bytes."""

from __future__ import annotations

import gzip
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import warc

ROWS = [
    (5, "http://a.example/x y", "same"), (3, "http://b.example/", "same"), (3, "http://c.example/", "same"), (None, None, "same"),
    (9, None, None), (8, "http://d.example/", ""), (10, "u", "é🙂\r\n\r\nWARC/1.1\r\n"), (None, "n1", "only nulls"), (None, "n2", "only nulls"),
    (11, "http://e.example/", "long " * 200_000), (-4, "m", "minus"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("extra", F.lit(1)).repartition(3)


def wanted(page_id, html):
    same = [i for i, _, h in ROWS if (h or "") == (html or "")]
    first = min((i for i in same if i is not None), default=None)
    revisit = len(same) > 1 and first is not None and page_id != first
    payload = (html or "").encode()
    return page_id, len(payload), warc.digest_of(payload), "revisit" if revisit else "response", first if revisit else None


@pytest.mark.parametrize("split", [50, 1000, 1 << 20])
def test_round_trip(pages, split):
    files = warc.write_warc(pages, file_bytes=3000)
    got = [tuple(r) for r in warc.read_warc(files, split_bytes=split).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == sorted((wanted(i, h) for i, _, h in ROWS), key=str)
    assert files.agg(F.sum("records")).first()[0] == len(ROWS)


def test_payloads_urls_and_digests(pages):
    read = warc.read_warc(warc.write_warc(pages)).collect()
    responses = [r for r in read if r.record_type == "response"]
    assert all(r.intact for r in read)
    assert {r.payload.decode() for r in responses} == {h or "" for _, _, h in ROWS}
    assert {r.url for r in read if r.page_id == 5} == {"http://a.example/x%20y"}


def test_other_tools_read_the_members(pages, tmp_path):
    for row in warc.write_warc(pages, str(tmp_path / "w")).collect():
        with gzip.open(row.path) as file:
            assert file.read().count(b"WARC/1.1\r\nWARC-Type: ") >= row.records


def test_listing(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w")).collect()
    assert warc.read_warc(warc.files_in(spark, str(tmp_path / "w"))).count() == len(ROWS)


def member(content, level=6):
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=level, mtime=0) as file:
        file.write(content)
    return out.getvalue()


def test_every_range_owns_its_records():
    rng = random.Random(4)
    parts, places = [], []
    for i in range(40):
        # Stored blocks keep bytes as they are: gzip magic, and members that hold no record, inside a payload.
        payload = rng.choice([rng.randbytes(300), b"x" + warc.MAGIC * 30, member(b"not a record"), warc.MAGIC + b"\x00" * 20])
        places.append(sum(map(len, parts)))
        parts.append(member(b"WARC/1.0\r\nWARC-Type: response\r\nX-Page-Id: %d\r\nContent-Length: %d\r\n\r\n" % (i, len(payload)) + payload + b"\r\n\r\n", rng.choice([0, 6])))
    data = b"".join(parts)
    for split in (1, 7, 64, 500, len(data), 10 * len(data)):
        found = [(at, int(f["x-page-id"])) for start in range(0, len(data), split) for at, f, _ in warc.records_in(io.BytesIO(data), start, start + split, len(data))]
        assert found == list(zip(places, range(40)))


def test_cut_file_is_an_error():
    data = member(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 9999\r\n\r\n" + random.Random(1).randbytes(9999))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_in(io.BytesIO(data[:5000]), 0, 5000, 5000))


def test_empty(spark, pages):
    assert warc.archived(pages.where(F.lit(False))).count() == 0


def test_ranges_are_read_by_as_many_tasks(spark):
    files = spark.createDataFrame([(f"file:///none/{i}", 40 * warc.SPLIT_BYTES) for i in range(100)], "path string, size long")
    assert warc.read_warc(files).rdd.getNumPartitions() == 4000


def test_a_header_of_any_length_is_read(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/" + "x" * (12 << 20), "body"), (2, "http://b/", "other")], "page_id long, url string, html string")
    got = warc.read_warc(warc.write_warc(pages, str(tmp_path))).select("page_id", F.length("url").alias("n"), "payload").collect()
    assert sorted((r.page_id, r.n, bytes(r.payload)) for r in got) == [(1, 9 + (12 << 20), b"body"), (2, 9, b"other")]


def test_a_record_without_a_whole_header_is_an_error():
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = packer.compress(b"WARC/1.1\r\nWARC-Type: response\r\nX: " + b"y" * 5000) + packer.flush()
    with pytest.raises(ValueError, match="cut off or damaged"):
        list(warc.records_in(io.BytesIO(data), 0, len(data), len(data)))
