"""Operator 7: WARC archives with segmented records.

Writing: one record per page. The block is an HTTP response whose body is the
page in chunked transfer framing. Of records with equal payloads the one with
the largest page id is a ``response``; the others are ``revisit`` records that
refer to it and carry no payload. A block longer than ``segment_bytes`` becomes
a first segment and ``continuation`` records (origin id, segment number, total
length on the last). Spark's text writer stores the records, so archives can
lie in any store that Spark reaches.

Reading: archives are parsed record by record; continuation records are
grouped by their origin's id and ordered by segment number as sorted rows, the
total length is verified, chunked framing is decoded, and a revisit takes
length and digest from the response it refers to. A record that fails a check
comes back with its problem in ``error``.

Cases: null html is an empty payload; null or odd urls are percent-encoded
into the header; rows that repeat a page id with the same payload are read
back as often as they were written; a null page id with a known payload
revisits it, else is a response; an empty table writes an empty archive and
reads no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.stage import stage_path, staged

VERSION = b"WARC/1.1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"  # the pages carry no crawl date


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string column, from its hex digest:
    ten hex digits are eight base32 digits."""
    digits = F.sha1(payload.cast("binary"))
    part = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    # Digits of base 32 as numbers, and as RFC 4648 writes them.
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def cuts(data: bytes, size: int) -> list[bytes]:
    """``data`` in parts of about ``size`` bytes that begin at characters."""
    out, at = [], 0
    while at < len(data):
        stop = min(at + size, len(data))
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop += 1
        out.append(data[at:stop])
        at = stop
    return out


def chunked(body: bytes, size: int) -> bytes:
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in cuts(body, size)) + b"0\r\n\r\n"


def dechunk(data: bytes) -> bytes:
    """Body of chunked transfer framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = data.index(b"\r\n", at)
        n = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if n == 0:
            return b"".join(out)
        if data[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        out.append(data[at:at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def page_records(page_id, url, html: str | None, digest: str, origin, revisit: bool, segment_bytes: int,
                 chunk_bytes: int) -> Iterator[bytes]:
    name = f"<urn:page:{'' if page_id is None else page_id}:{digest}>"
    common = [("WARC-Record-ID", name), ("WARC-Date", DATE)]
    if url is not None:
        common.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")))
    common.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        yield record([("WARC-Type", "revisit"), *common,
                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                      ("WARC-Refers-To", f"<urn:page:{origin}:{digest}>")], b"")
        return
    block = HTTP + chunked((html or "").encode("utf-8", "replace"), chunk_bytes)
    kind = ("Content-Type", "application/http; msgtype=response")
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *common, kind], block)
        return
    parts = cuts(block, segment_bytes)
    yield record([("WARC-Type", "response"), *common, kind, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        more = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"), ("WARC-Date", DATE),
                      ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", k), *more], part)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = 8192,
                   chunk_bytes: int = 4096, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", per_file: int = 4000) -> None:
    """Archives below ``path`` (gzip), about ``per_file`` pages each; payloads
    below ``min_bytes`` are always responses."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("html"), base32_sha1(html).alias("digest"),
                        F.octet_length(html).alias("n_bytes"))
    # combined on the map side; few payloads repeat, and the stage's size lets
    # the planner decide how to join them
    equal = staged(rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "op7-equal")
    joined = rows.join(equal, "digest", "left")
    revisit = F.col("origin").isNotNull() & (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("origin"))
    source = joined.select("page_id", "url", "html", "digest", "origin", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for row in zip(*[b.column(c) for c in ("page_id", "url", "html", "digest", "origin", "revisit")]):
                for r in page_records(*[v.as_py() for v in row], segment_bytes, chunk_bytes):
                    # the writer ends each row with CR LF, the end of a record
                    out.append(r[:-2].decode())
                    held += len(r)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    source.mapInArrow(run, "value string").write.option("lineSep", "\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", per_file).text(path)


def opened(data: bytes) -> tuple[bytes, str | None]:
    """What the gzip members hold, as far as they can be read, and the problem."""
    if data[:2] != b"\x1f\x8b":
        return data, None
    parts = []
    while data:
        member = zlib.decompressobj(31)
        try:
            parts.append(member.decompress(data))
        except zlib.error as e:
            return b"".join(parts), f"gzip: {e}"
        if not member.eof:
            return b"".join(parts), "gzip: a member is cut short"
        data = member.unused_data
    return b"".join(parts), None


def records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview, str | None]]:
    """(headers, block, problem) of each record; gzip members are opened first.
    Bytes that are no record end the file: the rest of it is one item without
    headers, whose problem says where it starts and why."""
    data, problem = opened(data)
    view, at = memoryview(data), 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if data[at:at + 5] != b"WARC/" or head < 0:
            yield {}, view[at:], f"no record at byte {at}"
            break
        lines = data[at:head].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = fields.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            yield {}, view[at:], f"no length of the record at byte {at}"
            break
        start = head + 4
        if len(data) - start < int(length):
            yield {}, view[at:], f"the record at byte {at} is cut short"
            break
        stop = start + int(length)
        yield fields, view[start:stop], None
        at = stop + 4
    if problem:
        yield {}, view[len(data):], problem


def _number(text: str | None) -> int | None:
    """A header's count, or None where there is none or it isn't one."""
    return int(text) if text and len(text) < 19 and text.isascii() and text.isdigit() else None


def payload(block: bytes) -> bytes:
    """Body of an HTTP block, unframed."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of HTTP header")
    return dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body


def _measure(block: bytes, digest: str | None) -> tuple[int | None, str | None, str | None]:
    """(length, digest, error) of a whole block's payload."""
    try:
        body = payload(block)
    except ValueError as e:
        return None, None, str(e)
    own = base64.b32encode(hashlib.sha1(body).digest()).decode()
    return len(body), own, None if digest in (None, own) else "digest differs"


FIELDS = [("name", pa.string()), ("kind", pa.string()), ("segment", pa.int64()), ("refers", pa.string()),
          ("total", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("error", pa.string()),
          ("block", pa.binary())]
SCHEMA = ("name string, kind string, segment long, refers string, total long, n_bytes long, digest string, "
          "error string, block binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(cols, FIELDS)],
                                      [n for n, _ in FIELDS])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(name, kind, refers, n_bytes, digest, error): one row per written record,
    continuations reassembled. ``name`` is the record id. What can't be read of a
    file is one row of kind ``unreadable`` (one more for a broken gzip member),
    named by the file, with its problem; the records before it are kept."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, data in zip(b.column("path").to_pylist(), b.column("content")):
                out, held = [], 0
                for f, block, problem in records(data.as_py()):
                    if problem:
                        out.append((file, "unreadable", None, None, None, None, None, problem, None))
                        continue
                    kind = f.get("warc-type", "")
                    number = _number(f.get("warc-segment-number"))
                    total = _number(f.get("warc-segment-total-length"))
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    name = f.get("warc-segment-origin-id") or f.get("warc-record-id")
                    if number is not None:
                        out.append((name, kind, number, None, total, None, digest, None, bytes(block)))
                        held += len(block)
                    elif kind == "revisit":
                        out.append((name, kind, None, f.get("warc-refers-to"), None, None, digest, None, None))
                    else:
                        out.append((name, kind, None, None, None, *_measure(bytes(block), digest), None))
                    if held > 8_000_000:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    parsed = files.mapInArrow(parse, SCHEMA)
    # whole records are a few numbers by now; only segments carry bytes
    ordered = parsed.repartition("name").sortWithinPartitions("name", "segment")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, total, digest, copies, seen = None, [], None, None, 0, 0

        def close() -> list[tuple]:
            if not parts:
                return []
            block = b"".join(parts)
            n, own, error = _measure(block, digest)
            if len(parts) != seen or total is None:
                n, own, error = None, None, "segments are missing"
            elif len(block) != total:
                n, own, error = None, None, f"{len(block)} bytes of {total}"
            return [(name, "response", 1, None, total, n, own, error, None)] * copies

        for b in batches:
            out = []
            for row in zip(*[b.column(c).to_pylist() for c, _ in FIELDS]):
                this, kind, number = row[:3]
                if number is None:
                    out.append(row)
                    continue
                if this != name:
                    out += close()
                    name, parts, total, digest, copies, seen = this, [], None, None, 0, 0
                if number == 1:
                    copies += 1
                    digest = row[6] or digest
                if number > seen:  # a record that was written twice repeats its segments
                    parts.append(row[8])
                    seen = number
                total = row[4] if row[4] is not None else total
            yield _batch(out)
        yield _batch(close())

    whole = staged(ordered.mapInArrow(assemble, SCHEMA).drop("block", "segment", "total"), "op7-read")
    # a revisit's payload is that of the response it refers to
    source = whole.where("kind = 'response'").select(
        F.col("name").alias("refers"), F.col("n_bytes").alias("length"), F.col("digest").alias("own")).dropDuplicates(
        ["refers"])
    revisits = whole.where("kind = 'revisit'").join(source, "refers", "left")
    error = F.when(F.col("own").isNull(), F.lit("response is missing")).when(
        F.col("own") != F.col("digest"), F.lit("digest differs"))
    return whole.where("kind != 'revisit'").select("name", "kind", "refers", "n_bytes", "digest", "error").unionByName(
        revisits.select("name", "kind", "refers", F.col("length").alias("n_bytes"), F.col("own").alias("digest"),
                        error.alias("error")))


def page_of(name: Column) -> Column:
    """Page id inside a record id."""
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes the archives and reads them back: (page_id, payload_bytes,
    payload_digest, record_type, refers_to, error) per page."""
    spark = pages.sparkSession
    path = path or stage_path(spark, "op7-archive")
    write_archives(pages, path, **options)
    return read_archives(spark, path).select(
        page_of(F.col("name")).alias("page_id"), F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        page_of(F.col("refers")).alias("refers_to"), "error")
