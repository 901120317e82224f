"""Operator 9: document fingerprints from prefix polynomial hashes.

Per text two modular prefix arrays over its code points answer the hash of
any span in O(1) (``span``), span equality, and by binary search the longest
common extension of two positions (``common_extension``). The fingerprint is
the whole-text span hash plus the least 32 hashes of the text's 8-character
spans; likeness of two fingerprints is the Jaccard estimate of those sketches.

Every text is paired with the next one by ascending id. Texts are shuffled
once, by id range; each task walks its sorted rows with two texts in memory
and hands its first and last row to a second, tiny step that pairs the edges
of neighbouring ranges.

Cases: null text counts as empty; an empty text has no spans and likeness 1
to another empty text, 0 to any other; rows with equal ids are ordered by
text; null ids come first; one row is its own successor; texts below 8
characters use one span; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm.stage import staged

WIDTH = 8
SKETCH = 32
ROWS = 512  # result rows held before they are handed on
# two primes below 2**31: products of residues fit in 62 bits
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, by doubling, kept per process."""
    if not _TABLES or len(_TABLES[0][0]) < n:
        _TABLES.clear()
        for p, b in zip(PRIMES, BASES):
            pair = []
            for base in (b, pow(b, -1, p)):
                t = np.ones(1, np.int64)
                while len(t) < max(n, 65536):
                    t = np.concatenate([t, t * pow(base, len(t), p) % p])
                pair.append(t)
            _TABLES.append(tuple(pair))
    return _TABLES


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        self.n = n = len(codes)
        self.codes = codes
        self.prefix = []
        for p, (up, _) in zip(PRIMES, _tables(n + 1)):
            s = np.zeros(n + 1, np.int64)
            np.cumsum(codes * up[:n] % p, out=s[1:])
            s %= p
            self.prefix.append(s)

    def span(self, i: int, j: int) -> int:
        """Hash of characters i..j-1, independent of where the span lies."""
        out = 0
        for p, s, (_, down) in zip(PRIMES, self.prefix, _tables(self.n + 1)):
            out = out << 31 | int(s[j] - s[i]) % p * int(down[i]) % p
        return out

    def windows(self, stop: int | None = None) -> np.ndarray:
        """Hashes of all spans of WIDTH characters within the first ``stop``."""
        n = self.n if stop is None else min(stop, self.n)
        if n == 0:
            return np.zeros(0, np.uint64)
        w = min(WIDTH, n)
        out = np.zeros(n - w + 1, np.uint64)
        for p, s, (_, down) in zip(PRIMES, self.prefix, _tables(self.n + 1)):
            v = (s[w:n + 1] - s[:n - w + 1]) % p * down[:n - w + 1] % p
            out = out << np.uint64(31) | v.astype(np.uint64)
        return out


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """Length of the longest common run that starts at a[i] and b[j]."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def sketch(windows: np.ndarray) -> np.ndarray:
    """The least SKETCH distinct values of the mixed span hashes, 48 bits."""
    x = windows * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x >>= np.uint64(16)
    q = 4 * SKETCH
    if len(x) > q:
        least = np.unique(np.partition(x, q)[:q])
        if len(least) >= SKETCH:
            return least[:SKETCH]
    return np.unique(x)[:SKETCH]


def encode(n: int, whole: int, least: np.ndarray) -> str:
    """Length, whole-text hash, and the sketch as six bytes a hash in base 64."""
    raw = least.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return f"{n:x}.{whole:016x}." + base64.urlsafe_b64encode(raw).decode()


def likeness(a: str, b: str) -> float:
    """Jaccard estimate from two fingerprints; 1 when they are equal."""
    if a == b:
        return 1.0
    raw = (base64.urlsafe_b64decode(f.rsplit(".", 1)[1]) for f in (a, b))
    sx, sy = ({r[i:i + 6] for i in range(0, len(r), 6)} for r in raw)
    union = sorted(sx | sy)[:SKETCH]
    if not union:
        return 0.0
    return sum(v in sx and v in sy for v in union) / len(union)


class Text:
    """A text with what its neighbours need of it."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.hash = PrefixHash(self.text)
        self.n = self.hash.n
        self.windows = self.hash.windows()
        self.fingerprint = encode(self.n, self.hash.span(0, self.n), sketch(self.windows))


def compare(a: Text, b: Text) -> tuple:
    """The row of text ``a`` whose successor is ``b``."""
    half = a.n // 2
    head, tail = a.n - half, min(half, b.n)
    edited = a.text[:head] + b.text[:tail]
    if head >= WIDTH and tail >= WIDTH:
        # spans inside either part keep their hashes; only those that straddle
        # the seam are new
        seam = PrefixHash(a.text[head - WIDTH + 1:head] + b.text[:WIDTH - 1])
        spans = np.concatenate([a.windows[:head - WIDTH + 1], seam.windows(), b.windows[:tail - WIDTH + 1]])
    else:
        spans = PrefixHash(edited).windows()
    whole = 0
    for p, sa, sb, (up, _) in zip(PRIMES, a.hash.prefix, b.hash.prefix, _tables(max(a.n, b.n) + 1)):
        whole = whole << 31 | (int(sa[head]) + int(sb[tail]) * int(up[head])) % p
    fp = encode(head + tail, whole, sketch(spans))
    kept = head + common_extension(a.hash, head, b.hash, 0) if half else head
    return (a.n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), a.fingerprint, fp,
            likeness(a.fingerprint, fp), likeness(a.fingerprint, b.fingerprint), min(kept, head + tail))


FIELDS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, kept_prefix long")
TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def _columns(rows: list[tuple]) -> list[pa.Array]:
    cols = list(zip(*rows)) if rows else [()] * len(TYPES)
    return [pa.array(list(c), t) for c, t in zip(cols, TYPES)]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprints of the text and of its edited text, likenesses)."""
    source = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # an id that stands on many rows is split: by its texts' digests, and equal
    # texts, whose order doesn't matter, by their place in the input
    source = source.withColumns({"digest": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    ordered = source.repartitionByRange("id", "digest", "place").sortWithinPartitions("id", "digest", "place").select("id", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None
        for b in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            ids, rows = [], []
            for i, t in zip(b.column("id").to_pylist(), b.column("text")):
                this = (i, Text(t.as_py()))
                if first is None:
                    first = (i, this[1].text)
                else:
                    ids.append(last[0])
                    rows.append(compare(last[1], this[1]))
                last = this
            none = pa.nulls(len(ids), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *_columns(rows), pa.nulls(len(ids), pa.int64()),
                 pa.nulls(len(ids), pa.int64()), none, none],
                ["id", *NAMES, "part", "first_id", "first_text", "last_text"])
        if first is not None:
            blank = [pa.nulls(1, t) for t in TYPES]
            yield pa.RecordBatch.from_arrays(
                [pa.array([last[0]], pa.int64()), *blank, pa.array([part], pa.int64()),
                 pa.array([first[0]], pa.int64()), pa.array([first[1]]), pa.array([last[1].text])],
                ["id", *NAMES, "part", "first_id", "first_text", "last_text"])

    walked = staged(ordered.mapInArrow(
        walk, f"id long, {FIELDS}, part long, first_id long, first_text string, last_text string"), "op9")
    inner = walked.where("part is null").select("id", *NAMES)

    # one row per range: ids only are ordered, then the texts are joined
    edges = walked.where("part is not null")
    rank = Window.orderBy(F.col("first_id").asc_nulls_first(), "id")
    order = edges.select("part", "first_id", "id").withColumn("k", F.row_number().over(rank)).select("part", "k")
    n = F.count(F.lit(1)).over(Window.partitionBy())
    order = order.withColumn("follows", F.col("k") % n + 1)
    left = edges.select("part", "id", "last_text").join(order.select("part", "follows"), "part")
    right = edges.select("part", "first_text").join(order.select("part", "k"), "part").drop("part")
    pairs = left.join(right, left.follows == right.k).select("id", "last_text", "first_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [compare(Text(x.as_py()), Text(y.as_py()))
                    for x, y in zip(b.column("last_text"), b.column("first_text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), *_columns(rows)], ["id", *NAMES])

    return inner.unionByName(pairs.mapInArrow(close, f"id long, {FIELDS}")).withColumnRenamed("id", id_col)
