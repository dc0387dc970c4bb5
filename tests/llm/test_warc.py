"""Operator 1: round trips, streams and offsets."""

import gzip
import os

import pytest

from sluice.llm.warc import Inflater, archive_round_trip, digest32, file_system, normalise, read_records, record, stream_records, write_archives
from sluice.session import scratch_path

PAGES = "page_id bigint, url string, html string, payload string, digest string, id string"
ROWS = [
    (1, "http://a/ b\r\n", "<p>é</p>", "x", "x", "x"), (2, None, None, None, None, None), (3, "http://c", "", "", "", ""),
    (5, "http://d", "<p>é</p>", "x", "x", "x"), (4, "http://e", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", "x", "x", "x"),
    (None, "http://f", "<p>é</p>", "x", "x", "x"), (None, "http://g", "alone", "x", "x", "x"), (7, "http://h", "y" * 300_000, "x", "x", "x"),
    (8, "http://i", "twin", "x", "x", "x"), (8, "http://i", "twin", "x", "x", "x"), (-3, "http://j", "zz", "x", "x", "x"), (9, "http://k", "zz", "", "", ""),
]


def want(rows, least=0):
    out = []
    for ident, _, html, *_ in rows:
        p = (html or "").encode()
        same = [i for i, _, h, *_ in rows if (h or "").encode() == p and i is not None]
        first = min(same) if same and len(p) >= least else None
        revisit = first is not None and ident != first
        out.append((ident, len(p), digest32(p), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    df = spark.createDataFrame(ROWS, PAGES).repartition(3)
    got = archive_round_trip(df, min_revisit_bytes=least).collect()
    assert sorted(map(tuple, got), key=repr) == want(ROWS, least)


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_members_index_and_payloads(spark):
    df = spark.createDataFrame(ROWS, PAGES).coalesce(1)
    manifest = write_archives(df, scratch_path(spark, "t-raw"), file_bytes=1000)
    assert manifest.count() > 1 and manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    index = normalise(manifest, scratch_path(spark, "t-warc"))
    by_file = {}
    for r in index.collect():
        by_file.setdefault(r.archive, []).append(r)
    for path, entries in by_file.items():
        fs, inner = file_system(path)
        with fs.open_input_file(inner) as f:
            data = f.read()
        entries.sort(key=lambda r: r.offset)
        at = 0
        for e in entries:  # members follow one another without gaps, each one record
            assert e.offset == at
            member = gzip.decompress(data[e.offset : e.offset + e.length])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
            assert e.record_id.encode() in member
            at += e.length
        assert at == len(data)
        with fs.open_input_file(inner + ".index.jsonl") as f:
            assert f.read().count(b"\n") == len(entries)
    payloads = {r.record_id: bytes(r.payload) for r in read_records(index).collect() if r.record_type == "response"}
    assert "y" * 300_000 in {p.decode() for p in payloads.values()}


class Source:
    def __init__(self, data, step):
        self.data, self.at, self.step = data, 0, step

    def read(self, n):
        piece = self.data[self.at : self.at + min(n, self.step)]
        self.at += len(piece)
        return piece


def records_of(data, step):
    return [(f["warc-record-id"], b"".join(block)) for f, _, block in stream_records(Inflater(Source(data, step)))]


def test_streams_of_any_form_and_step():
    parts = [record(i, "u", os.urandom(50 * i), None, "2000-01-01T00:00:00Z") for i in range(6)]
    whole = b"".join(parts)
    plain = records_of(whole, 1 << 20)
    assert [len(b) for _, b in plain] and len(plain) == 6
    for data in (whole, gzip.compress(whole), b"".join(map(gzip.compress, parts)), gzip.compress(whole) + gzip.compress(b"")):
        for step in (1, 7, 1 << 20):
            assert records_of(data, step) == plain
    assert records_of(b"", 10) == []


def test_damaged_streams_raise():
    data = gzip.compress(record(1, "u", b"x" * 5000, None, "2000-01-01T00:00:00Z"))
    with pytest.raises(ValueError):
        records_of(data[:-20], 100)
    with pytest.raises(ValueError):
        records_of(gzip.compress(b"no record\r\n\r\n"), 100)
    with pytest.raises(ValueError):
        records_of(record(1, "u", b"x" * 5000, None, "2000-01-01T00:00:00Z")[:-400], 100)
