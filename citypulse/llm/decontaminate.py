"""Operator 10: benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents (2**18 counters).
2. A latent space: TF-IDF vectors of the benchmark's passages together with
   every distinct passage of the corpus, over the benchmark's and the corpus'
   most frequent word buckets (``VOCABULARY``); a distributed randomised SVD
   (random projection, power iterations, a small solve) keeps ``rank``
   directions, far fewer than there are passages. Words that occur in the same
   passages lie close, so a paraphrase by other words is near its original. The
   passages are written once, two bytes a word; rows stay in Spark, and what
   reaches the driver is vocabulary x rank.
3. Every document is cut into windows of the passage length at half its step;
   their folded-in latent vectors (scaled by the inverse roots of the singular
   values: what all texts of a language share counts less, the noise of rare
   words not as much as topics do) are compared with every benchmark passage by
   cosine. The benchmark is searched in passes of
   ``TOGETHER`` passages that each add to the document's own row.
   Beside it, passages of at most 8 or 16 words are also searched in windows of
   that length by their TF-IDF cosine, so the words around a short copy do not
   dilute it, and word runs equal to a whole benchmark passage are candidates
   whatever their cosine: a verbatim copy is always found.
4. Candidates are checked on word sequences: the longest common subsequence
   of the benchmark passage and the document around the hit must cover
   ``min_lcs`` of it, and its answer (the ``answer`` column, else the last
   words of the item) must be covered as well. ``best_cosine`` is the TF-IDF
   cosine of the best of the checked hits, 0 without one.

Cases: null and empty texts and items have no passage and no hit; an item
shorter than a passage is one passage, down to one word; an empty benchmark
flags nothing; repeated items and documents are kept, each row with its own
result; ids may be null; ties keep every item; clashing extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.kernels import BASE, BASE_INV, U, mix, powers, row_of, slices, utf8, words
from citypulse.llm.stage import released, staged

BITS = 18
PASSAGE = 32
STRIDE = 8
SHORT = (8, 16)  # window lengths for benchmark passages of at most as many words
BLOCK = 256  # short passages that share a matrix
TOGETHER = 4096  # passages that a pass over the documents searches for
CHAIN = 4  # passes over a document before its row is written
VOCABULARY = 16_384  # word buckets of the latent space
BANDS = 1024  # vocabulary rows per partial product
MARKS = 1024  # a word's hash sets one of so many marks of the windows around it
ENTRIES = 1 << 18  # matrix entries that are multiplied together


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """(documents with each word bucket, documents) over all rows."""
    df, n, _ = _frequencies(docs, text_col)
    return df, n


def _frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int, int]:
    """(documents with each word bucket, documents, words) over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, n_words = np.zeros(1 << BITS, np.int64), 0, 0
        for b in batches:
            for some in slices(b, "text"):
                h, off = words(some.column("text"))
                key = np.sort(row_of(off) << BITS | bucket(h))
                first = np.ones(len(key), bool)
                first[1:] = key[1:] != key[:-1]
                total += np.bincount(key[first] & ((1 << BITS) - 1), minlength=1 << BITS)
                n += some.num_rows
                n_words += len(h)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(total[at], [n, n_words]))],
                                         ["bucket", "n"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most 2**18 + 2 rows
    at, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    df = np.zeros(1 << BITS, np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return df, int(n[at == -1].sum()), int(n[at == -2].sum())


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log((n + 1.0) / (df + 0.5)).astype(np.float32).clip(0.05)


def passages(off: np.ndarray, size: int = PASSAGE, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the passages that cover every word of each row;
    the last one ends with its row."""
    n = np.diff(off)
    count = np.where(n > size, -(-(n - size) // stride) + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = off[row] + np.minimum(nth * stride, np.maximum(n[row] - size, 0))
    return row, start, np.minimum(start + size, off[row + 1])


def _tfidf(b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(b, return_counts=True)
    v = weight[at] * np.sqrt(count)
    return at, v / max(float(np.linalg.norm(v)), 1e-9)


def benchmark_rows(items: DataFrame, weight: np.ndarray, id_col: str, text_col: str, answer_col: str | None,
                   answer_words: int, stride: int = PASSAGE // 2) -> DataFrame:
    """(item_id, words, answer, features, values) per benchmark passage; the
    word hashes of the passage and of the answer ride along for the check."""
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    source = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"),
                          answer.alias("answer"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, off = words(b.column("text"))
            ah, aoff = words(b.column("answer"))
            out: list[list] = [[], [], [], [], []]
            for r, item in enumerate(b.column("item_id").to_pylist()):
                w = h[off[r]:off[r + 1]]
                given = ah[aoff[r]:aoff[r + 1]]
                for s in passages(np.array([0, len(w)]), PASSAGE, stride)[1]:
                    p = w[s:s + PASSAGE]
                    at, v = _tfidf(bucket(p), weight)
                    tail = given if len(given) else w[-answer_words:]
                    for k, x in zip(out, (item, p.view(np.int64).tolist(), tail.view(np.int64).tolist(),
                                          at.tolist(), v.astype(float).tolist())):
                        k.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), *[pa.array(x, pa.list_(pa.int64())) for x in out[1:4]],
                 pa.array(out[4], pa.list_(pa.float64()))], ["item_id", "words", "answer", "features", "values"])

    return source.mapInArrow(
        run, "item_id long, words array<long>, answer array<long>, features array<long>, values array<double>")


def _places(vocabulary: np.ndarray, words: int = 1 << BITS) -> np.ndarray:
    """The place in the vocabulary of every word bucket, -1 for the others."""
    place = np.full(words, -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
    return place


def _place_type(vocabulary: np.ndarray) -> np.dtype:
    return np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")


def corpus_rows(docs: DataFrame, text_col: str, weight: np.ndarray, share: float = 1.0,
                vocabulary: np.ndarray | None = None) -> DataFrame:
    """(places, norm) of the documents' passages, equal ones once: the places in
    the vocabulary of a passage's words, ascending, and the length of its whole
    TF-IDF vector. A ``share`` below 1 draws passages by a hash of their words."""
    vocabulary = np.arange(1 << BITS) if vocabulary is None else vocabulary
    shared = docs.sparkSession.sparkContext.broadcast((weight, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, vocabulary = shared.value
        place, stored = _places(vocabulary), _place_type(vocabulary)
        square = weight.astype(np.float64) ** 2
        for b in batches:
            for some in slices(b, "text"):
                h, off = words(some.column("text"))
                _, start, stop = passages(off, PASSAGE, PASSAGE)
                digest = run_digest(h, start, stop - start)
                _, drawn = np.unique(digest, return_index=True)
                if share < 1:
                    drawn = drawn[(digest[drawn] >> U(11)).astype(np.float64) * 2.0 ** -53 < share]
                start, n = start[drawn], (stop - start)[drawn]
                row = np.repeat(np.arange(len(n)), n)
                at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                word = np.sort(row << BITS | bucket(h[at])) & ((1 << BITS) - 1)
                # words of a passage count by the root of their number: their squares add up
                norm = np.sqrt(np.bincount(row, square[word], len(n)))
                mine = place[word]
                known = mine >= 0
                cut = np.concatenate([[0], np.cumsum(np.bincount(row[known], minlength=len(n)))]) * stored.itemsize
                data = np.sort((row[known] << BITS) | mine[known]) & ((1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[drawn].view(np.int64)),
                     pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(cut.astype(np.int32)),
                                                                 pa.py_buffer(data.astype(stored))]),
                     pa.array(np.maximum(norm, 1e-9))], ["digest", "places", "norm"])

    drawn = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "digest long, places binary, norm double")
    return drawn.dropDuplicates(["digest"]).select("places", "norm")


Matrix = tuple[np.ndarray, np.ndarray, np.ndarray]  # entries by row: first entry of each row, place, value


def _listed(b: pa.RecordBatch, place: np.ndarray) -> Matrix:
    """Rows (features, values)."""
    f, v = b.column("features"), b.column("values")
    row = row_of(f.offsets.to_numpy())
    at, v = place[f.flatten().to_numpy()], v.flatten().to_numpy()
    known = at >= 0
    return np.searchsorted(row[known], np.arange(len(f) + 1)), at[known], v[known]


def _stored(b: pa.RecordBatch, weight: np.ndarray, stored: np.dtype) -> Matrix:
    """Rows (places, norm); ``weight`` by place."""
    data, off = utf8(b.column("places"))
    at = data.view(stored).astype(np.int64)
    off //= stored.itemsize
    row = row_of(off)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    v = weight[at[first]] * np.sqrt(count) / b.column("norm").to_numpy()[row[first]]
    return np.searchsorted(first, off), at[first], v


def _sums(source: np.ndarray, at: np.ndarray, v: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
    """For each segment of ``off`` the sum of its entries' values times their rows
    of ``source``, by products of blocks of ``size`` entries."""
    n = np.diff(off)
    blocks = -(-n // size)
    of = np.repeat(np.arange(len(n)), blocks)
    begin = off[of] + size * (np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    left = off[of + 1] - begin
    part = np.empty((len(of), source.shape[1]), source.dtype)
    step = max(1, 8192 // size)  # what a step works on stays in the processor's cache
    rows = np.empty((step, size, source.shape[1]), source.dtype)
    places = np.arange(size)
    at, v = np.append(at, np.zeros(size, at.dtype)), np.append(v, np.zeros(size)).astype(source.dtype)
    for k in range(0, len(of), step):
        entry = begin[k:k + step, None] + places
        value = v[entry] * (places < left[k:k + step, None])
        some = rows[:len(entry)]
        np.take(source, at[entry], axis=0, out=some, mode="clip")
        part[k:k + step] = np.matmul(value[:, None, :], some)[:, 0]
    out = np.zeros((len(n), source.shape[1]), source.dtype)
    full = np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(part, (np.cumsum(blocks) - blocks)[full], axis=0)
    return out


def _add_gram(total: np.ndarray, q: np.ndarray, matrix: Matrix, square: bool = False) -> None:
    """Adds A'(A q) of some rows to ``total``, or (A q)'(A q) if ``square``."""
    off, at, v = matrix
    done = 0
    while done < len(off) - 1:
        stop = max(done + 1, int(np.searchsorted(off, off[done] + ENTRIES, side="right")) - 1)
        a, w, cut = at[off[done]:off[stop]], v[off[done]:off[stop]], off[done:stop + 1] - off[done]
        done = stop
        y = _sums(q, a, w, cut, PASSAGE)
        if square:
            total += y.T @ y
            continue
        order = np.argsort(a.astype(np.uint16) if len(q) <= 1 << 16 else a, kind="stable")
        a = a[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])[:len(a)])
        total[a[first]] += _sums(y, row_of(cut)[order], w[order], np.append(first, len(a)), PASSAGE)


def _latent(rows: DataFrame, vocabulary: np.ndarray, rank: int, rounds: int = 2, seed: int = 5,
            corpus: DataFrame | None = None, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(orthonormal vocabulary x rank basis, singular values) of the sparse
    matrix in ``rows`` (features, values) and ``corpus`` (places, norm), by
    randomised subspace iteration: each round sums A'(A Q) over Spark
    partitions. Words outside the vocabulary don't count."""
    wide = min(rank + 8, len(vocabulary))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(vocabulary), wide)))[0]
    mine = weight[vocabulary].astype(np.float64) if weight is not None else None

    def gram(q: np.ndarray, square: bool = False) -> np.ndarray:
        height = wide if square else len(vocabulary)
        shared = rows.sparkSession.sparkContext.broadcast((q, vocabulary, mine))

        def summing(listed: bool):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                q, vocabulary, mine = shared.value
                q = q.astype(np.float32)  # single precision in the products, double in their sum
                place, stored = _places(vocabulary), _place_type(vocabulary)
                total = np.zeros((height, wide))
                for b in batches:
                    _add_gram(total, q, _listed(b, place) if listed else _stored(b, mine, stored), square)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(0, height, BANDS), pa.int64()),
                     pa.array([total[k:k + BANDS].tobytes() for k in range(0, height, BANDS)], pa.binary())],
                    ["at", "part"])
            return run

        def summed(pdf: pd.DataFrame) -> pd.DataFrame:
            whole = sum(np.frombuffer(x) for x in pdf["part"])
            return pd.DataFrame({"at": pdf["at"].iloc[:1], "part": [whole.tobytes()]})

        parts = rows.select("features", "values").mapInArrow(summing(True), "at long, part binary")
        if corpus is not None:
            parts = parts.unionByName(corpus.mapInArrow(summing(False), "at long, part binary"))
        found = parts.groupBy("at").applyInPandas(summed, "at long, part binary").collect()  # vocabulary x rank
        shared.destroy()
        out = np.zeros((height, wide))
        for r in found:
            out[r["at"]:r["at"] + BANDS] = np.frombuffer(bytes(r["part"])).reshape(-1, wide)
        return out

    for _ in range(rounds):
        q = np.linalg.qr(gram(q))[0]
    small = gram(q, square=True)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:rank]
    # below this the products' rounding is all there is
    order = order[values[order] > 1e-6 * max(values.max(), 1e-30)]
    return q @ vectors[:, order], np.sqrt(values[order])


def latent_basis(rows: DataFrame, vocabulary: np.ndarray, rank: int, rounds: int = 2, seed: int = 5) -> np.ndarray:
    """Orthonormal (vocabulary x rank) basis of the leading right singular vectors."""
    return _latent(rows, vocabulary, rank, rounds, seed)[0]


def latent_space(docs: DataFrame, text_col: str, rows: DataFrame, weight: np.ndarray, freq: np.ndarray, n_words: int,
                 rank: int) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary, map): the folding-in map takes TF-IDF weights of the
    vocabulary's words to latent coordinates. All passages of the ``n_words``
    words are learnt from."""
    used = rows.select(F.explode("features").alias("b")).distinct().toArrow()["b"].to_numpy()  # at most 2**18
    order = np.argsort(-freq, kind="stable")
    mine = used[np.argsort(-freq[used], kind="stable")][:VOCABULARY]
    others = order[~np.isin(order, mine)][:VOCABULARY - len(mine)]
    vocabulary = np.sort(np.concatenate([mine, others[freq[others] > 0]]))
    corpus = released(corpus_rows(docs, text_col, weight, vocabulary=vocabulary), "op10-passages") if n_words else None
    n = rows.count() + (corpus.count() if n_words else 0)
    basis, sigma = _latent(rows, vocabulary, max(1, min(rank, n // 2, len(vocabulary))), corpus=corpus, weight=weight)
    return vocabulary, (basis / np.sqrt(sigma)).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & where.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


STATE = "contaminated boolean, items array<long>, best_lcs double, best_cosine double"


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None,
         rank: int = 64, min_latent: float = 0.5, min_cosine: float = 0.45, min_lcs: float = 0.6,
         min_answer: float = 0.5, answer_words: int = 6) -> DataFrame:
    """(id, contaminated, items, best_lcs, best_cosine) for every document."""
    freq, n, n_words = _frequencies(docs, text_col)
    weight = idf(freq, n)
    rows = staged(benchmark_rows(items, weight, item_col, item_text, answer_col, answer_words), "op10-items")
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                      F.lit(False).alias("contaminated"), F.array().cast("array<long>").alias("items"),
                      F.lit(0.0).alias("best_lcs"), F.lit(0.0).alias("best_cosine"))
    count = rows.count()
    if count:
        space = latent_space(docs, text_col, rows, weight, freq, n_words, rank)
        # the index is held by every task: about TOGETHER passages at a time. Each
        # pass adds to the rows of the one before, so nothing is joined by id
        passes = -(-count // TOGETHER)
        for k in range(passes):
            mine = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(passes)) == k) if passes > 1 else rows
            index = mine.orderBy("item_id", "words").toArrow().to_pylist()
            if index:
                out = _search(out, index, weight, space, min_latent, min_cosine, min_lcs, min_answer)
            if (k + 1) % CHAIN == 0 and k + 1 < passes:
                out = staged(out, "op10-rows")
    return out.select(F.col("id").alias(id_col), "contaminated", "items", "best_lcs", "best_cosine")


def _blocks(index: list[dict]) -> list[tuple]:
    """(window length, places in ``index``, vocabulary, vocabulary x passages)
    of the short passages."""
    out = []
    for size in SHORT:
        mine = [k for k, r in enumerate(index) if 0 < len(r["words"]) <= size]
        for at in (mine[i:i + BLOCK] for i in range(0, len(mine), BLOCK)):
            some = [index[k] for k in at]
            vocabulary = np.unique(np.concatenate([r["features"] for r in some]))
            matrix = np.zeros((len(vocabulary), len(some)), np.float32)
            for k, r in enumerate(some):
                matrix[np.searchsorted(vocabulary, r["features"]), k] = r["values"]
            out.append((size, np.array(at), vocabulary, matrix))
    return out


def _folded(b: np.ndarray, off: np.ndarray, place: np.ndarray, fold: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, latent unit vector) of every window of ``PASSAGE`` words, half
    of it apart; the halves are summed once and added in pairs. ``fold`` holds
    the weighted words' vectors and a last row of zeros, which ``place`` gives
    to all other words."""
    half = PASSAGE // 2
    n = np.diff(off)
    count = np.maximum(1, -(-n // half)) * (n > 0)
    row = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = off[row] + nth * half
    at = start[:, None] + np.arange(half)
    word = np.where(at < off[row + 1][:, None], place[b][np.minimum(at, max(len(b) - 1, 0))] if len(b) else 0, len(fold) - 1)
    halves = np.zeros((len(start), fold.shape[1]), np.float32)
    for j in range(half):
        halves += fold[word[:, j]]
    both = halves.copy()
    pair = np.flatnonzero(row[1:] == row[:-1])
    both[pair] += halves[pair + 1]
    # a row's last half is in the window before it already
    lone = np.ones(len(row), bool)
    lone[pair + 1] = False
    last = np.ones(len(row), bool)
    last[pair] = False
    keep = ~last | lone
    both = both[keep]
    norm = np.sqrt((both ** 2).sum(axis=1, keepdims=True))
    return row[keep], start[keep], both / np.maximum(norm, 1e-12)


def _short(h: np.ndarray) -> np.ndarray:
    """32 bits of each hash, above 1: equal words stay equal."""
    return np.maximum((h & U(0xFFFFFFFF)).astype(np.uint32), 2)


def run_digest(h: np.ndarray, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Digest of the ``size`` words from each start."""
    prefix = np.zeros(len(h) + 1, U)
    np.cumsum(h * powers(BASE, len(h)), out=prefix[1:])
    return mix((prefix[start + size] - prefix[start]) * powers(BASE_INV, len(h) + 1)[start])


def _search(source: DataFrame, index: list[dict], weight: np.ndarray, space: tuple[np.ndarray, np.ndarray],
            min_latent: float, min_cosine: float, min_lcs: float, min_answer: float) -> DataFrame:
    """Every document against some of the benchmark's passages; adds to the
    results that its rows carry."""
    runs: dict[int, dict[int, list[int]]] = {}  # length -> digest -> places in index
    for k, r in enumerate(index):
        w = np.array(r["words"], np.int64).view(U)
        runs.setdefault(len(w), {}).setdefault(int(run_digest(w, np.zeros(1, np.int64), len(w))[0]), []).append(k)
    opening = np.unique(np.array([r["words"][0] for r in index], np.int64).view(U))
    vocabulary, fold = space
    place = np.full(1 << BITS, len(vocabulary), np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    fold = np.concatenate([fold * weight[vocabulary][:, None], np.zeros((1, fold.shape[1]), np.float32)])
    word = np.array([x for r in index for x in r["words"]], np.int64).view(U)
    off = np.concatenate([[0], np.cumsum([len(r["words"]) for r in index])])
    latent = np.add.reduceat(fold[place[bucket(word)]], off[:-1])
    latent /= np.maximum(np.sqrt((latent ** 2).sum(axis=1, keepdims=True)), 1e-12)
    padded = np.zeros((len(index), PASSAGE), np.uint32)  # 0 stands for no word
    padded[np.arange(PASSAGE) < np.diff(off)[:, None]] = _short(word)
    marked = np.where(padded > 0, padded % MARKS, MARKS)  # no window has the last mark
    spark = source.sparkSession
    shared = spark.sparkContext.broadcast(
        (weight, _blocks(index), runs, opening, [r["item_id"] for r in index], [r["words"] for r in index],
         [r["answer"] for r in index], [(np.array(r["features"]), np.array(r["values"])) for r in index],
         place, fold, latent.T.copy(), padded, marked, np.diff(off)))

    def check(w: np.ndarray, start: int, k: int, size: int) -> float | None:
        """Share of passage k that the words around a hit hold in order."""
        _, _, _, _, _, item_words, item_answer, *_ = shared.value
        p = item_words[k]
        slack = len(p) // 2
        near = w[max(0, start - slack):start + size + slack].view(np.int64).tolist()
        lcs = common_subsequence(p, near) / len(p)
        if lcs < min_lcs:
            return None
        answer = item_answer[k]
        inside = common_subsequence(answer, p) >= len(answer)
        # an answer outside this passage is looked for in the words that follow
        wide = near if inside else w[max(0, start - 8 * PASSAGE):start + 9 * PASSAGE].view(np.int64).tolist()
        if answer and common_subsequence(answer, wide) < min_answer * len(answer) and lcs < 0.9:
            return None
        return lcs

    def search(h: np.ndarray, off: np.ndarray) -> tuple[list[dict[int, float]], np.ndarray]:
        """Items found in each row of a slice, and its best cosine."""
        (weight, blocks, runs, opening, item_of, item_words, _, vectors, place, fold, latent, padded, marked,
         length) = shared.value
        found: list[dict[int, float]] = [{} for _ in range(len(off) - 1)]
        top = np.zeros(len(off) - 1)
        tried: set[tuple[int, int]] = set()
        b, small = bucket(h), _short(h)

        def hit(r: int, start: int, k: int, size: int) -> None:
            if (start, k) in tried:
                return
            tried.add((start, k))
            w = h[off[r]:off[r + 1]]
            lcs = check(w, int(start - off[r]), k, size)
            if lcs is not None:
                found[r][item_of[k]] = max(found[r].get(item_of[k], 0.0), lcs)
                # TF-IDF cosine of the words under the hit
                at, v = _tfidf(b[start:min(start + max(size, len(item_words[k])), off[r + 1])], weight)
                features, values = vectors[k]
                _, i, j = np.intersect1d(at, features, assume_unique=True, return_indices=True)
                top[r] = max(top[r], float(v[i] @ values[j]))

        # the latent space
        row, begin, unit = _folded(b, off, place, fold)
        step = max(1, 8_000_000 // latent.shape[1])
        for cut in range(0, len(row), step):
            near, which = np.nonzero(unit[cut:cut + step] @ latent >= min_latent)
            near += cut
            for c in range(0, len(near), 8192):
                j, k = near[c:c + 8192], which[c:c + 8192]
                # words of the passage that stand around the window bound the subsequence
                window, of = np.unique(j, return_inverse=True)
                at = begin[window][:, None] + np.arange(-PASSAGE // 2, PASSAGE + PASSAGE // 2)
                inside = (at >= off[row[window]][:, None]) & (at < off[row[window] + 1][:, None])
                there = np.where(inside, small[np.clip(at, 0, len(h) - 1)], 1)
                # no fewer of its words have a mark there
                marks = np.zeros((len(window), MARKS + 1), bool)
                marks[np.arange(len(window))[:, None], there % MARKS] = True
                some = np.flatnonzero(marks[of[:, None], marked[k]].sum(axis=1) >= min_lcs * length[k])
                for d in range(0, len(some), 2000):
                    x = some[d:d + 2000]
                    shared_words = (padded[k[x]][:, :, None] == there[of[x]][:, None, :]).any(axis=2).sum(axis=1)
                    for y in x[shared_words >= min_lcs * length[k[x]]]:
                        hit(int(row[j[y]]), int(begin[j[y]]), int(k[y]), PASSAGE)
        # short passages in windows of their own length
        square = weight[b].astype(np.float64) ** 2
        full = np.concatenate([[0], np.cumsum(square)])
        cuts = {size: passages(off, size, size // 4) for size in {x[0] for x in blocks}}
        for size, at, vocabulary, matrix in blocks:
            row, start, stop = cuts[size]
            local = np.full(1 << BITS, -1, np.int32)
            local[vocabulary] = np.arange(len(vocabulary))
            mine = local[b]
            known = np.concatenate([[0], np.cumsum(np.where(mine >= 0, square, 0))])
            norm2 = full[stop] - full[start]
            # the share of a window's weight on the block's words bounds its cosine
            hot = np.flatnonzero((known[stop] - known[start] >= min_cosine ** 2 * norm2) & (norm2 > 0))
            term = weight[vocabulary]
            for cut in range(0, len(hot), 512):
                some = hot[cut:cut + 512]
                # distinct benchmark words of each window, with counts
                length = stop[some] - start[some]
                of = np.repeat(np.arange(len(some)), length)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length)
                word = mine[start[some][of] + nth]
                key, count = np.unique((of * len(vocabulary) + word)[word >= 0], return_counts=True)
                of, word = np.divmod(key, len(vocabulary))
                terms = matrix[word] * (term[word] * np.sqrt(count).astype(np.float32))[:, None]
                first = np.searchsorted(of, np.arange(len(some)))  # a hot window has a benchmark word
                cos = np.add.reduceat(terms, first) / np.sqrt(norm2[some])[:, None]
                for j, k in zip(*np.nonzero(cos >= min_cosine)):
                    hit(int(row[some[j]]), int(start[some[j]]), int(at[k]), size)
        # word runs equal to a whole passage
        opens = np.flatnonzero(np.isin(h, opening))
        home = np.searchsorted(off, opens, side="right") - 1
        for size, known_runs in runs.items():
            inside = opens + size <= off[home + 1]
            digest = run_digest(h, opens[inside], size)
            same = np.isin(digest, np.fromiter(known_runs, U, len(known_runs)))
            for r, s, d in zip(home[inside][same].tolist(), opens[inside][same].tolist(), digest[same].tolist()):
                for k in known_runs[d]:
                    hit(r, s, k, size)
        return found, top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text", 1_000_000):
                h, off = words(some.column("text"))
                found, top = search(h, off)
                before = [x or [] for x in some.column("items").to_pylist()]
                hits = [sorted({*old, *new}) for old, new in zip(before, found)]
                best = [max(x.values(), default=0.0) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("text"), pa.array([bool(x) for x in hits]),
                     pa.array(hits, pa.list_(pa.int64())),
                     pa.array(np.maximum(best, some.column("best_lcs").to_numpy())),
                     pa.array(np.maximum(np.minimum(top, 1.0), some.column("best_cosine").to_numpy()))],
                    ["id", "text", "contaminated", "items", "best_lcs", "best_cosine"])

    return source.mapInArrow(run, f"id long, text string, {STATE}")
