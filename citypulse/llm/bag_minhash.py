"""Operator 4: near-duplicate documents by BagMinHash.

A document is the multiset of its five-word shingles (words: lower-cased runs
of letters and digits). Its weights, the counts, are discretised into dyadic
levels [0,1), [1,2), [2,4), ...; every (shingle, level) owns a Poisson process
whose rate is the level's width times the number of registers. A point has a
time, a position inside the level (it counts if the position lies below the
weight: thinning) and a register; each register keeps its least time. Equal
registers then occur with probability equal to the weighted Jaccard
similarity. Points are drawn in time order only up to a horizon at which all
registers are filled, so a shingle costs about one draw and not one per
register.

Registers are banded; candidates are verified by their exact multiset overlap,
sum of least counts over sum of greatest counts, at 0.8 or more.
Texts with the same words in the same order are one node. See ``linking`` for
how buckets become classes.

The signature pass only maps; ids, digests and bands are what is shuffled, and
shingles of candidate documents only.

Cases: a text with fewer than five words has one shingle of all its words; a
text without words (null, empty, punctuation only) is compared by equality,
null and blank texts being in no class but their own; rows of one id are
told apart by their digest; the class is named by its least doc_id, null where
none of its rows has an id; ``keep`` marks the rows of that id, more than one
where rows share it (``one_of_each`` picks one); clashing extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.kernels import BASE, U, counted, mix, sequence_digest, shingles, slices, words
from citypulse.llm.linking import link
from citypulse.llm.stage import small_side, staged

SHINGLE = 5
ROWS, BANDS = 5, 24  # an overlap of 0.8 meets in some band with probability 0.9999
REGISTERS = ROWS * BANDS
THRESHOLD = 0.8
MERGING = 0.02  # whole documents are worth more draws before the exact join


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def registers(h: np.ndarray, row: np.ndarray, weight: np.ndarray, n_rows: int) -> np.ndarray:
    """Least point time per (row, register); infinite for rows without shingles."""
    out = np.full((n_rows, REGISTERS), np.inf)
    mass = np.bincount(row, weight, minlength=n_rows)
    # (shingle, level) processes: level 0 for every shingle, level j for weights above 2**(j-1)
    key, at, low, width = [mix(h)], [np.arange(len(h))], [np.zeros(len(h))], [np.ones(len(h))]
    j = 1
    while True:
        heavy = np.flatnonzero(weight > 2 ** (j - 1))
        if not len(heavy):
            break
        key.append(mix(h[heavy] + U(j * BASE % 2 ** 64)))
        at.append(heavy)
        low.append(np.full(len(heavy), 2.0 ** (j - 1)))
        width.append(np.full(len(heavy), 2.0 ** (j - 1)))
        j += 1
    key, at, low, width = (np.concatenate(x) for x in (key, at, low, width))
    owner, limit = row[at], weight[at]
    open_rows = mass > 0
    factor = np.log(REGISTERS) + 4.0
    while open_rows.any():
        horizon = np.where(open_rows, factor / np.maximum(mass, 1), -1.0)
        live = np.flatnonzero(open_rows[owner])
        state, time = key[live], np.zeros(len(live))
        while len(live):
            state = mix(state + U(0x632BE59BD9B4E019))
            time = time - np.log(_uniform(state)) / (width[live] * REGISTERS)
            on = time <= horizon[owner[live]]
            live, state, time = live[on], state[on], time[on]
            draw = mix(state ^ U(0x5851F42D4C957F2D))
            inside = low[live] + np.floor(_uniform(mix(draw)) * width[live]) < limit[live]
            some = live[inside]
            reg = (draw[inside] % U(REGISTERS)).astype(np.int64)
            np.minimum.at(out.reshape(-1), owner[some] * REGISTERS + reg, time[inside])
        open_rows &= np.isinf(out).any(axis=1)
        factor *= 2
    return out


def bands(reg: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    bits = mix(reg.view(U))
    keys = np.zeros((len(reg), BANDS), U)
    for r in range(ROWS):
        keys = keys * U(BASE) + bits[:, r::ROWS]
    return mix(keys + np.arange(BANDS, dtype=U))


def _bag(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    h, off = words(col)
    sh, row = shingles(h, off, SHINGLE)
    return (*counted(sh, row), h, off)


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, d1, d2, n_words, bands array) per row; map only. ``mark`` is the
    digest of the text itself."""
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text"):
                col = some.column("text")
                h, row, count, word, off = _bag(col)
                n = some.num_rows
                keys = bands(registers(h, row, count.astype(np.float64), n))
                size = np.diff(off)
                d1, d2 = sequence_digest(word, off, 11), sequence_digest(word, off, 12)
                bare = np.flatnonzero(size == 0)
                if len(bare):  # no words: equality of the text itself
                    texts = [col[int(i)].as_py() for i in bare]
                    for i, t in zip(bare, texts):
                        raw = np.frombuffer((t or "").encode(), np.uint8).astype(U)
                        d1[i] = mix(np.array([np.bitwise_xor.reduce(mix(raw + np.arange(1, len(raw) + 1, dtype=U)
                                                                        * U(BASE)), initial=U(len(raw)))]))[0]
                        d2[i] = U(0) if t is None or not t.strip() else U(1)
                flat = pa.array(keys.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), flat)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("mark"), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array(size.astype(np.int64)), lists],
                    ["id", "mark", "d1", "d2", "n_words", "bands"])

    return source.mapInArrow(run, "id long, mark long, d1 long, d2 long, n_words long, bands array<long>")


def _members(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, n_words, copy_of, class_id, root) per row; ``root`` tells
    classes apart whatever their ids."""
    sig = staged(signatures(df, id_col, text_col), "op4-signatures")
    # null and blank texts (d2 = 0 and no words) stay alone
    lone = (F.col("n_words") == 0) & (F.col("d2") == 0)
    rep = sig.where(~lone).groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    member = staged(sig.where(~lone).select("id", "mark", "d1", "d2", "n_words").join(rep, ["d1", "d2"]), "op4-members")
    # texts of the same words are one node, named by the digest; the row that stands for it is the least id's
    reps = member.where("id <=> rep").select(F.col("id").alias("r"), F.col("d1").alias("r1"), F.col("d2").alias("r2")).distinct()
    marks = sig.where(~lone & (F.col("n_words") > 0)).join(
        reps, F.col("id").eqNullSafe(F.col("r")) & (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2")), "left_semi")
    marks = marks.dropDuplicates(["d1", "d2"]).withColumn("node", F.xxhash64("d1", "d2"))
    marks = staged(marks.select("node", "id", "d1", "bands"), "op4-nodes")
    buckets = marks.select(F.explode("bands").alias("bucket"), F.col("node").alias("id"))

    def features(ids: DataFrame) -> DataFrame:
        wanted = staged(marks.select(F.col("node").alias("id"), F.col("id").alias("doc"), "d1").join(
            ids, "id"), "op4-wanted")
        # only the documents of some bucket are shingled again; texts stay where they are
        side = small_side(wanted.select(F.col("doc").alias("w")).distinct())
        docs = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).join(
            side, F.col("doc").eqNullSafe(F.col("w")), "left_semi")
        named = wanted.withColumnsRenamed({"doc": "w", "d1": "w1"})
        found = _bags(docs).join(named, F.col("doc").eqNullSafe(F.col("w")) & (F.col("d1") == F.col("w1")))
        return found.select("id", "s").dropDuplicates(["id"])

    linked = link(buckets, features, THRESHOLD, MERGING)
    named = linked.join(marks.select(F.col("node").alias("id"), F.col("id").alias("rep")), "id")
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = named.join(least, "root").select(F.col("id").alias("node"), "root", "class_id")
    out = member.withColumn("node", F.xxhash64("d1", "d2")).join(named, "node", "left").select(
        "id", "mark", "n_words", F.col("rep").alias("copy_of"),
        F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("root", "node").alias("root"))
    alone = sig.where(lone).select("id", "mark", "n_words", F.col("id").alias("copy_of"), F.col("id").alias("class_id"),
                                   F.lit(None).cast("long").alias("root"))
    return out.unionByName(alone)


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: (doc_id, class_id, copy_of, n_words, keep).
    ``copy_of`` is the least id with the same words."""
    return _members(df, id_col, text_col).select(
        F.col("id").alias(id_col), "class_id", "copy_of", "n_words",
        F.col("id").eqNullSafe(F.col("class_id")).alias("keep"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each class: that of its least (id, text digest),
    rows without an id last; null and blank texts stay."""
    rows = staged(_members(df, id_col, text_col).select("id", "mark", "root"), "op4-rows")
    counted = rows.where(F.col("root").isNotNull()).groupBy("root", "id", "mark").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "n")).alias("x")).select("x.id", "x.mark", "x.n")
    alone = rows.where(F.col("root").isNull()).select("id", "mark").distinct().withColumn("n", F.lit(1).cast("long"))
    stay = staged(first.unionByName(alone).select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), "n"), "op4-stay")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__mark"))
    once = df.join(stay.where("n = 1"), same, "left_semi")
    # equal rows: one of them
    again = df.join(stay.where("n > 1"), same, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(again)


def _bags(docs: DataFrame) -> DataFrame:
    """(doc, d1, s): each multiset as a set of (shingle, k-th occurrence) codes,
    so that its weighted overlap is the plain overlap of the codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text"):
                h, row, count, word, off = _bag(some.column("text"))
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                code = mix(np.repeat(h, count) + nth.astype(U) * U(BASE))
                owner = np.repeat(row, count)
                cut = np.searchsorted(owner, np.arange(some.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc"), pa.array(sequence_digest(word, off, 11).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(code.view(np.int64)))], ["doc", "d1", "s"])

    return docs.mapInArrow(run, "doc long, d1 long, s array<long>")
