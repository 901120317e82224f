"""Operator 6: quality by supervised subword embeddings.

Every white-space word and every character n-gram of 3 to 5 bytes inside a
word (with its boundary) is hashed to a learned vector; a document is the
mean of its vectors and a softmax layer gives the class. Vectors and layer are
trained by stochastic gradient descent in numpy.

Training uses labelled rows only, and of more than ``max_rows`` of them a
hash sample of that expected size (the documented bound; what reaches the
driver is that sample's bucket counts). Scoring reads whole texts: with a
linear layer over a mean, the score needs one number per bucket, so each text
costs one gather per n-gram.

Cases: null and empty texts have no feature and score the prior given by the
layer's bias; without labels of both classes every score is the share of
class 1 (0.5 when there is no label at all); a null label is ignored; of
several labels of one id each counts; clashing extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.kernels import BASE, BASE_INV, U, mix, powers, row_of, slices, spans, utf8
from citypulse.llm.stage import small_side

BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
STEP = 1_000_000
SPACE_BYTE = np.zeros(256, bool)
SPACE_BYTE[[9, 10, 11, 12, 13, 32]] = True


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and n-gram occurrence of the column."""
    data, off = utf8(pc.fill_null(col, ""))
    word, word_off = spans(data, off, ~SPACE_BYTE)
    buckets = [(word >> U(48)).astype(np.int32)]
    rows = [row_of(word_off)]
    n = len(data)
    space = SPACE_BYTE[data]
    flat = np.where(space, np.uint8(32), data)
    prefix = np.zeros(n + 1, U)
    np.cumsum((flat.astype(U) + U(1)) * powers(BASE, n), out=prefix[1:])
    gaps = np.zeros(n + 1, np.int32)
    np.cumsum(space, out=gaps[1:])
    row = row_of(off)
    down = powers(BASE_INV, n)
    for g in GRAMS:
        if n < g:
            continue
        # inside one row, with white space at the ends only
        ok = (gaps[g - 1:n] - gaps[1:n - g + 2] == 0) & (row[g - 1:] == row[:n - g + 1])
        at = np.flatnonzero(ok)
        h = mix((prefix[at + g] - prefix[at]) * down[at] + U(g))
        buckets.append((h >> U(48)).astype(np.int32))
        rows.append(row[at])
    return np.concatenate(buckets), np.concatenate(rows)


class Model:
    """Score = sigmoid(mean of ``weight`` over the features + ``bias``)."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight.astype(np.float32), float(bias)

    def score(self, col: pa.Array) -> np.ndarray:
        bucket, row = features(col)
        n = np.bincount(row, minlength=len(col))
        total = np.bincount(row, self.weight[bucket], minlength=len(col))
        z = total / np.maximum(n, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 0.5,
          seed: int = 7) -> Model:
    """SGD over (label, buckets, shares): the shares of a document sum to 1."""
    labels = [y for y, _, _ in samples]
    if len(set(labels)) < 2:
        p = min(max(sum(labels) / len(labels), 1e-6), 1 - 1e-6) if labels else 0.5
        return Model(np.zeros(BUCKETS), np.log(p / (1 - p)))
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    layer = np.zeros((DIM, 2), np.float32)
    layer[:, 1] = (rng.random(DIM) - 0.5) / DIM
    bias = np.zeros(2, np.float32)
    steps, k = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            y, at, share = samples[i]
            lr = rate * (1 - k / steps)
            k += 1
            hidden = share @ vectors[at] if len(at) else np.zeros(DIM, np.float32)
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            back = layer @ p
            layer -= lr * np.outer(hidden, p)
            bias -= lr * p
            if len(at):
                # scaled by the number of features: each takes the full step of its mean
                vectors[at] -= lr * np.outer(share * min(len(at), 64), back)
    d = layer[:, 1] - layer[:, 0]
    return Model(vectors @ d, bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = 2500) -> Model:
    """Model from the rows of ``docs`` that ``labels`` marks 0 or 1."""
    # a label that stands on several rows counts once, so one id can't fill the sample
    marked = labels.where(F.col(label).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).distinct()
    n = marked.count()
    if n > max_rows:
        draw = F.pmod(F.xxhash64("id", "y"), F.lit(1 << 30)) / float(1 << 30)
        marked = marked.where(draw < max_rows / n)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        small_side(marked), "id").select("id", "y", "text")
    # an id may stand on many documents: drawn again by text, equal texts once
    found = rows.select("id", "y", F.xxhash64("text").alias("mark")).distinct().count()
    if found > 2 * max_rows:
        rows = rows.where(F.pmod(F.xxhash64("text", "id"), F.lit(1 << 30)) / float(1 << 30) < 2 * max_rows / found)
        rows = rows.dropDuplicates(["id", "y", "text"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text", STEP):
                bucket, row = features(some.column("text"))
                key, count = np.unique(row.astype(np.int64) * BUCKETS + bucket, return_counts=True)
                cut = np.searchsorted(key, np.arange(some.num_rows + 1, dtype=np.int64) * BUCKETS)
                at = [(key[s:e] % BUCKETS).astype(np.int32) for s, e in zip(cut, cut[1:])]
                c = [count[s:e].astype(np.float32) for s, e in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("y"), pa.array([x.tobytes() for x in at], pa.binary()),
                     pa.array([x.tobytes() for x in c], pa.binary())], ["id", "y", "bucket", "count"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, y int, bucket binary, count binary"
    got = sorted(map(tuple, rows.mapInArrow(emit, schema).collect()), key=lambda r: (r[0] is None, *r[:2], r[2]))
    samples = []
    for _, y, bucket, count in got:
        c = np.frombuffer(bytes(count), np.float32)
        samples.append((y, np.frombuffer(bytes(bucket), np.int32), c / max(float(c.sum()), 1.0)))
    return train(samples)


def score(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus the score of every whole text."""
    source = df.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    weight, bias = model.weight.tobytes(), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(np.frombuffer(weight, np.float32), bias)
        for b in batches:
            for some in slices(b, "__text", STEP):
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in keep], pa.array(m.score(some.column("__text")))], [*keep, "score"])

    return source.mapInArrow(run, source.select(*keep).schema.add("score", "double"))
