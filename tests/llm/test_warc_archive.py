"""WARC archives: every member and offset against Python's own gzip, on odd and repeated pages."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import zlib

import pytest

from tarnlake.llm import warc_archive
from tarnlake.session import work_path

SCHEMA = "page_id long, url string, html string, value string, archive string, digest string"
LONG = "<p>long é\r\n\r\n</p>" * 400
SAME = "same\r\n" * 300


def _pages():
    return [
        (1, "http://a/1", "short", "x", "y", "z"),
        (2, "http://a/2", "short", "x", "y", "z"),
        (3, None, None, None, None, None),
        (4, "http://a/ 4\r\nX: y", "", None, None, None),
        (5, "http://a/5", SAME, None, None, None),
        (6, "http://a/6", SAME, None, None, None),
        (6, "http://a/6", SAME, None, None, None),
        (None, "http://a/n", SAME, None, None, None),
        (None, None, LONG, None, None, None),
        (8, "http://a/8", "ends in line ends\r\n\r\n", None, None, None),
        (9, "http://a/9", "ends in one\r\n", None, None, None),
        (10, "http://a/10", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc", None, None, None),
        (11, "http://a/11", "x" * 3_000_000, None, None, None),
        (12, "http://a/12", "y" * 999, None, None, None),
        (13, "http://a/13", "y" * 999, None, None, None),
    ] + [(100 + i, f"http://hot/{i}", "hot" * 400, None, None, None) for i in range(200)]


@pytest.fixture(scope="module")
def archived(spark):
    pages = spark.createDataFrame(_pages(), SCHEMA).repartition(3)
    streams, archives = work_path(spark, "streams"), work_path(spark, "archives")
    warc_archive.write_monolithic(warc_archive.warc_records(pages), streams)
    done = warc_archive.normalise(spark, streams, archives)
    return streams, archives, done.collect()


def _local(path):
    return path.removeprefix("file://")


def test_records_read_back(spark, archived):
    biggest = {}
    for key, _, html, *_ in _pages():
        if len((html or "").encode()) >= 1000:
            biggest[html] = max(biggest.get(html, -1), -1 if key is None else key)
    want = []
    for key, _, html, *_ in _pages():
        body = (html or "").encode()
        last = biggest.get(html, -1)
        again = last != -1 and key != last
        want.append((key, len(body), hashlib.sha1(body).hexdigest(),
                     "revisit" if again else "response", last if again else None,
                     None if again else body))
    rows = warc_archive.read_records(spark, archived[1]).withColumns(
        {c: warc_archive.page_key(warc_archive.F.col(c)) for c in ("record_id", "refers_to")}
    )
    got = [
        (r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
         None if r.payload is None else bytes(r.payload))
        for r in rows.collect()
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_every_member_stands_alone_at_its_offset(archived):
    streams, archives, done = archived
    names = {n for n in os.listdir(_local(archives)) if n.endswith(".warc.gz") and n[0] != "."}
    assert names == {r.archive for r in done}
    assert not [n for n in os.listdir(_local(archives)) if n[0] == "." and not n.endswith(".crc")]
    bodies = 0
    for r in done:
        whole = open(os.path.join(_local(archives), r.archive), "rb").read()
        lines = open(os.path.join(_local(archives), r.archive + ".index.json")).read().splitlines()
        assert len(lines) == r.records and len(whole) == r.bytes
        at, joined = 0, b""
        for entry in map(json.loads, lines):
            assert entry["offset"] == at
            member = zlib.decompressobj(31)
            record = member.decompress(whole[at : at + entry["length"]])
            assert member.eof and not member.unused_data and record.startswith(b"WARC/1.1\r\n")
            joined, at = joined + record, at + entry["length"]
        assert at == len(whole)
        bodies += len(joined)
    sources = [n for n in os.listdir(_local(streams)) if n.endswith(".gz")]
    one_stream = [open(os.path.join(_local(streams), n), "rb").read() for n in sources]
    assert sum(len(gzip.decompress(s)) for s in one_stream) == bodies
    for data in one_stream:
        first = zlib.decompressobj(31)
        first.decompress(data)
        assert first.eof and not first.unused_data


def test_urls_stay_on_one_line(spark, archived):
    index = warc_archive.read_index(spark, archived[1]).where("record_id = '<urn:page:4>'").collect()
    assert [r.uri for r in index] == ["http://a/%204%0D%0AX:%20y"]


def test_part_of_an_index(spark, archived):
    index = warc_archive.read_index(spark, archived[1]).where("record_type = 'revisit'")
    rows = warc_archive.read_records(spark, archived[1], index).collect()
    assert len(rows) == index.count() == 201 and {r.payload for r in rows} == {None}


def test_normalised_archives_can_be_normalised_again(spark, archived):
    again = work_path(spark, "again")
    warc_archive.normalise(spark, archived[1] + "/*.warc.gz", again)
    first = warc_archive.read_records(spark, archived[1]).collect()
    assert sorted(first, key=repr) == sorted(warc_archive.read_records(spark, again).collect(), key=repr)


def test_no_pages(spark):
    pages = spark.createDataFrame([], SCHEMA)
    streams, archives = work_path(spark, "streams"), work_path(spark, "archives")
    warc_archive.write_monolithic(warc_archive.warc_records(pages), streams)
    warc_archive.normalise(spark, streams, archives)
    assert warc_archive.read_records(spark, archives).count() == 0


@pytest.mark.parametrize("data", [b"no archive\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])
def test_broken_streams_are_refused(spark, tmp_path, data):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match=r"no WARC record|ends inside a record"):
        warc_archive.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
