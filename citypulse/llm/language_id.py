"""Operator 5: language identification by hyperdimensional profiles.

Each letter has a random +-1 vector; a letter trigram is the product of its
letters' vectors, permuted by position (binding); a text is the sum of its
trigram vectors (bundling); a language prototype is the sum of the normalised
vectors of its training texts. A text gets the language whose prototype has
the greatest cosine, ties going to the first by name.

Letters are lower-cased; any run of other characters is one boundary symbol.
Prototypes are learned from labelled rows only; of a language with more than
``max_docs_per_lang`` labelled rows a hash sample of that expected size is
used (a documented bound, the only sample here). Prediction reads whole texts
and nothing but the text.

Cases: null text or no letter gives ``und`` and score 0; nothing to learn from
gives ``und`` everywhere; a negative cosine scores 0; repeated rows are
predicted separately; clashing extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.kernels import slices

DIM = 1024
SLOTS = 1024
LOW = 0x250  # letters below have slots of their own, others share by remainder
DOCS = 64
STEP = 400_000
QUANT = 1 << 20
_STATE: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Slot of each code point: 0 for a non-letter."""
    if "slot" not in _STATE:
        table = np.zeros(0x110000, np.uint16)
        for cp in range(0x110000):
            if chr(cp).isalpha():
                table[cp] = cp + 1 if cp < LOW else LOW + 1 + cp % (SLOTS - LOW - 1)
        _STATE["slot"] = table
        rng = np.random.default_rng(20240607)
        base = rng.integers(0, 2, (SLOTS, DIM), dtype=np.int8) * np.int8(2) - np.int8(1)
        _STATE["c"] = base
        _STATE["b"] = np.roll(base, 1, axis=1)
        _STATE["a"] = np.roll(base, 2, axis=1)
    return _STATE["slot"]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    _letters()
    return (_STATE["a"][codes >> 20] * _STATE["b"][(codes >> 10) & 1023] * _STATE["c"][codes & 1023]).astype(np.float32)


def trigrams(text: str) -> np.ndarray:
    """Codes of the text's letter trigrams, with one boundary at each end."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    slot = _letters()[cps]
    s = np.zeros(len(slot) + 2, np.int64)
    s[1:-1] = slot
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    if len(s) < 3:
        return np.zeros(0, np.int64)
    return s[:-2] << 20 | s[1:-1] << 10 | s[2:]


def bundle(texts: list[str | None]) -> np.ndarray:
    """One vector per text (zero where there is no letter)."""
    grams = [trigrams(t) if t else np.zeros(0, np.int64) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    codes = np.concatenate(grams) if grams else np.zeros(0, np.int64)
    out = np.zeros((len(texts), DIM), np.float32)
    if not len(codes):
        return out
    key, count = np.unique(row << 30 | codes, return_counts=True)
    codes, at = np.unique(key & ((1 << 30) - 1), return_inverse=True)
    matrix = np.zeros((len(texts), len(codes)), np.float32)
    matrix[key >> 30, at] = count
    for k in range(0, len(codes), 8192):
        out += matrix[:, k:k + 8192] @ trigram_vectors(codes[k:k + 8192])
    return out


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for part in slices(batch, "text", STEP):
        for k in range(0, part.num_rows, DOCS):
            some = part.slice(k, DOCS)
            yield some, bundle(some.column("text").to_pylist())


def learn(df: DataFrame, label: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          max_docs_per_lang: int = 1500) -> dict[str, np.ndarray]:
    """Unit prototypes by language from the non-null labels of ``df``."""
    rows = df.where(F.col(label).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label).cast("string").alias("label"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not sizes:
        return {}
    part = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, max_docs_per_lang / n))])
    draw = F.pmod(F.xxhash64("id", "label"), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.where(draw < part[F.col("label")]).select("label", "text")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for some, vec in _groups(b):
                norm = np.linalg.norm(vec, axis=1, keepdims=True)
                unit = np.rint(vec / np.maximum(norm, 1e-9) * QUANT).astype(np.int64)  # exact in any order
                for k, v in zip(some.column("label").to_pylist(), unit):
                    total[k] = total.get(k, 0) + v
        for k, v in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * DIM), pa.array(np.arange(DIM)), pa.array(v)], ["label", "dim", "value"])

    summed = rows.mapInArrow(sums, "label string, dim long, value long").groupBy("label", "dim").agg(
        F.sum("value").alias("value"))
    out = {k: np.zeros(DIM) for k in sizes}
    for r in summed.collect():  # languages x DIM numbers
        out[r["label"]][r["dim"]] = r["value"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if np.any(v)}


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus lang_pred and score for every row."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[k] for k in names], np.float32).reshape(len(names), DIM).T
    source = df.select(*[F.col(c) for c in keep], F.col(text_col).alias("text")) if text_col not in keep \
        else df.select(*keep)
    if text_col != "text" and text_col in keep:
        raise ValueError("the text column is named 'text' when it is carried over")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lang, score = [], []
            for some, vec in _groups(b):
                norm = np.linalg.norm(vec, axis=1)
                if not names:
                    lang += ["und"] * some.num_rows
                    score += [0.0] * some.num_rows
                    continue
                cos = vec @ matrix / np.maximum(norm, 1e-9)[:, None]
                best = cos.argmax(axis=1)
                lang += ["und" if z == 0 else names[k] for k, z in zip(best, norm)]
                score += [0.0 if z == 0 else float(min(max(c[k], 0.0), 1.0)) for c, k, z in zip(cos, best, norm)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "score"])

    schema = source.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(run, schema)


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as '')."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % mod
