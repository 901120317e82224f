import base64
import gzip
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citypulse.llm import warc as W


def want(rows):
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        o = best[h or ""]
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if i == o else "revisit", None if i == o else o))
    return sorted(out)


ROWS = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://ü/ \r\nevil: 1", "é" * 9001), (4, "u", None), (5, "u", ""),
        (6, "u", "WARC/1.1\r\n\r\n0\r\n\r\n" * 3000), (7, "u", "x"), (7, "u", "x"), (8, "u", "é" * 9001)]


@pytest.mark.parametrize("segment", [200, 8192, 10 ** 9])
def test_round_trip(spark, segment):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'c' as digest", "1 as n")
    got = W.round_trip(df, segment_bytes=segment, chunk_bytes=64).collect()
    assert all(r.error is None for r in got)
    assert sorted(tuple(r)[:5] for r in got) == want(ROWS)


def test_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert sorted(tuple(r)[:5] for r in W.round_trip(pages).collect()) == want(rows)


def test_minimum_size(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")],
                               "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in W.round_trip(df, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert W.round_trip(df.where("false")).count() == 0


def test_damaged_archives_are_reported(spark, tmp_path):
    parts = list(W.page_records(5, "u", "text " * 500, "D", None, False, 300, 100))
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(parts[:2] + parts[3:])))
    (tmp_path / "b.warc").write_bytes(b"".join(reversed(list(W.page_records(6, "u", "t" * 900, "E", None, False, 300, 100)))))
    rows = {r.name: r for r in W.read_archives(spark, str(tmp_path)).collect()}
    assert rows["<urn:page:5:D>"].error
    assert rows["<urn:page:6:E>"].error == "digest differs" and rows["<urn:page:6:E>"].n_bytes == 900


def test_foreign_files_end_no_job(spark, tmp_path):
    good = b"".join(W.page_records(5, "u", "text", "D", None, False, 300, 100))
    files = {"noise": b"\x00\xff no archive", "tail": good + b"<html>", "nolength": good + b"WARC/1.1\r\nA: b\r\n\r\nxx",
             "cut": good[:-30], "headless": good + b"WARC/1.1\r\nContent-Length: 3", "empty": b"",
             "badgzip": gzip.compress(good) + b"padding", "cutgzip": gzip.compress(good)[:-12],
             "minus": good + b"WARC/1.1\r\nContent-Length: -3\r\n\r\nxyz"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = W.read_archives(spark, str(tmp_path)).collect()
    bad = {r.name.rsplit("/", 1)[1]: r.error for r in rows if r.kind == "unreadable"}
    assert set(bad) == set(files) - {"empty"}
    assert bad["noise"] == "no record at byte 0" and bad["cut"] == "the record at byte 0 is cut short"
    assert bad["tail"] == f"no record at byte {len(good)}" and bad["minus"].startswith("no length")
    assert bad["badgzip"].startswith("gzip:") and bad["cutgzip"].startswith("gzip:")
    whole = [r for r in rows if r.kind == "response"]  # the digest D is not theirs
    assert len(whole) >= 5 and {r.n_bytes for r in whole} == {4}


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=200))
def test_any_bytes_are_read_without_raising(data):
    for raw in (data, b"WARC/1.0\r\n" + data, b"\x1f\x8b" + data, gzip.compress(data)[:-3]):
        list(W.records(raw))


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 50))
def test_chunked(body, size):
    assert W.dechunk(W.chunked(body, size)) == body


def test_foreign_chunks():
    assert W.dechunk(b"3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n") == b"abc0123456789"
    with pytest.raises(ValueError):
        W.dechunk(b"3\r\nabcd\r\n0\r\n\r\n")
