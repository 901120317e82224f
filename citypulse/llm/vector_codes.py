"""Operator 12: vector code compression by cover-tree Lloyd.

A vector is cut into equal parts; each part position has its own codebook,
refined by Lloyd rounds, and a vector's code is the list of its parts' nearest
entries. All arithmetic is on integers, so results are exact and do not depend
on partitions or their order.

Every batch of a partition gets one cover tree per part position, built once
and staged: a node has a centre (one of its points), the radius that covers
its subtree, and the subtree's cumulative count and component sums; its
children are a greedy net at half the separation. A round walks the trees from
the roots with the set of entries that can still be nearest: by the triangle
inequality an entry farther from the centre than the best one by more than
twice the radius is nearest to no point below. A node with one entry left gives
its sums to it as a whole; only ambiguous nodes go on to their children, and at
the leaves to exact comparisons with the entries left, ties to the lower index.

What reaches the driver are codebooks: parts x entries x width sums per round,
a size fixed by parameters and dimension. A batch holds at most ``CHUNK``
components, whatever the partition's size.

Cases: rows whose vector is null or holds null or non-finite components are
dropped, vectors of another length than the most frequent one too; a dimension
that the parts do not divide is filled up with zeros; ids may be null (they
come last in the choice of first entries) or repeated (ordered by their
components); fewer rows than entries give fewer entries; entries without parts
stay as they are; equal entries: the lower index wins; null labels are one
group; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from citypulse.llm.stage import small_side, staged
from citypulse.llm.vectors import integer_vectors, matrix

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CHUNK = 1_000_000  # components per tree batch
LEAF = 16  # points of a node that is not split further
WALK = 4096  # nodes whose distances to all entries are held at once


class Tree(NamedTuple):
    """Points in tree order; a node owns points[start:stop], its centre first."""
    points: np.ndarray
    row: np.ndarray  # place among the points of each input row
    start: np.ndarray
    stop: np.ndarray
    radius: np.ndarray
    child: np.ndarray  # first child; children are neighbours
    children: np.ndarray  # how many; 0 for a leaf
    count: np.ndarray  # rows below a node, and per point
    total: np.ndarray  # component sums below a node
    weight: np.ndarray


def build(rows: np.ndarray) -> Tree:
    """Cover tree over the distinct rows of an integer matrix."""
    points, inverse, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    n = len(points)
    order = np.arange(n)
    gap = ((points - points[0]) ** 2).sum(axis=1)
    start, stop = [np.zeros(1, np.int64)], [np.full(1, n)]
    radius = [np.sqrt(gap.max(keepdims=True).astype(np.float64))]
    first_child, how_many = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    nodes = 1
    # nodes to split: their number, range
    node, low, high = np.zeros(1, np.int64), start[0], stop[0]
    reach = radius[0][0] / 2
    if n <= LEAF:
        node = node[:0]
    while len(node):
        place = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
        owner = np.repeat(np.arange(len(node)), high - low)
        left = np.arange(len(place))
        net = np.zeros(len(place), np.int64)  # which child of its node
        far = np.zeros(len(place), np.int64)
        nth = 0
        while len(left):
            new = np.ones(len(left), bool)
            new[1:] = owner[left[1:]] != owner[left[:-1]]
            centre = place[left[new]][np.cumsum(new) - 1]
            d = ((points[order[place[left]]] - points[order[centre]]) ** 2).sum(axis=1)
            near = d <= reach * reach
            net[left[near]], far[left[near]] = nth, d[near]
            left = left[~near]
            nth += 1
        by = np.lexsort((np.arange(len(place)), net, owner))
        order[place] = order[place[by]]
        key_owner, key_net, far = owner[by], net[by], far[by]
        head = np.ones(len(by), bool)
        head[1:] = (key_owner[1:] != key_owner[:-1]) | (key_net[1:] != key_net[:-1])
        cut = np.flatnonzero(head)
        born_low, born_high = place[cut], place[np.append(cut[1:], len(by)) - 1] + 1
        born_owner, born_far = key_owner[cut], np.sqrt(np.maximum.reduceat(far, cut).astype(np.float64))
        number = np.bincount(born_owner, minlength=len(node))
        # a node whose net is its centre alone stays and is split at the next scale
        real = number[born_owner] > 1
        for k, cols in zip((start, stop, radius), (born_low, born_high, born_far)):
            k.append(cols[real])
        fresh = int(real.sum())
        first_child.append(np.zeros(fresh, np.int64))
        how_many.append(np.zeros(fresh, np.int64))
        split = np.flatnonzero(number > 1)
        at = nodes + np.cumsum(number[split]) - number[split]
        flat_child, flat_many = np.concatenate(first_child), np.concatenate(how_many)
        flat_child[node[split]], flat_many[node[split]] = at, number[split]
        first_child, how_many = [flat_child], [flat_many]
        again = np.flatnonzero(number == 1)
        node, low, high = (np.concatenate([a, b]) for a, b in (
            (node[again], nodes + np.arange(fresh)), (low[again], born_low[real]), (high[again], born_high[real])))
        nodes += fresh
        big = high - low > LEAF
        node, low, high = node[big], low[big], high[big]
        by = np.argsort(low)
        node, low, high = node[by], low[by], high[by]
        reach /= 2
    start, stop, radius = np.concatenate(start), np.concatenate(stop), np.concatenate(radius)
    points, weight = points[order], weight[order]
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    sums = np.zeros((n + 1, points.shape[1] + 1), np.int64)
    np.cumsum(np.column_stack([weight, points * weight[:, None]]), axis=0, out=sums[1:])
    below = sums[stop] - sums[start]
    small = np.int16 if np.abs(points).max(initial=0) < 2 ** 15 else np.int32
    return Tree(points.astype(small), back[inverse.reshape(-1)].astype(np.int32), start.astype(np.int32),
                stop.astype(np.int32), radius, first_child[0].astype(np.int32), how_many[0].astype(np.int32),
                below[:, 0], below[:, 1:], weight.astype(np.int32))


def _ragged(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each of the ranges."""
    total = np.cumsum(many)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - many), many)


def nearest(tree: Tree, entries: np.ndarray, each: bool = False):
    """Counts and component sums per entry; with ``each``, the entry and the
    squared distance of every input row instead."""
    distinct, lowest = np.unique(entries, axis=0, return_index=True)
    by = np.argsort(lowest)
    book, name = distinct[by].astype(np.int64), lowest[by]  # equal entries: the lower index
    count = np.zeros(len(entries), np.int64)
    total = np.zeros(entries.shape, np.int64)
    chosen = np.full(len(tree.points), -1, np.int64)
    node = np.zeros(1, np.int64)
    mask = np.ones((1, len(book)), bool)
    while len(node):
        below, below_mask = [], []
        for k in range(0, len(node), WALK):
            at, may = node[k:k + WALK], mask[k:k + WALK]
            centre = tree.points[tree.start[at]].astype(np.int64)
            d = np.sqrt(((centre[:, None, :] - book[None]) ** 2).sum(axis=2).astype(np.float64))
            d[~may] = np.inf
            best = d.min(axis=1, keepdims=True)
            # the margin covers the rounding of roots; it only keeps more entries
            may = d <= best + 2 * tree.radius[at][:, None] + 1e-9 * (best + 1)
            alone = may.sum(axis=1) == 1
            whole, entry = at[alone], name[may[alone].argmax(axis=1)]
            if each:
                size = tree.stop[whole] - tree.start[whole]
                chosen[_ragged(tree.start[whole], size)] = np.repeat(entry, size)
            else:
                np.add.at(count, entry, tree.count[whole])
                np.add.at(total, entry, tree.total[whole])
            open_, rest = at[~alone], may[~alone]
            leaf = tree.children[open_] == 0
            if leaf.any():
                size = tree.stop[open_[leaf]] - tree.start[open_[leaf]]
                point = _ragged(tree.start[open_[leaf]], size)
                of, which = np.nonzero(np.repeat(rest[leaf], size, axis=0))
                d2 = ((tree.points[point[of]].astype(np.int64) - book[which]) ** 2).sum(axis=1)
                cut = np.flatnonzero(np.diff(of, prepend=-1))
                low = np.minimum.reduceat(d2, cut)
                tie = np.where(d2 == low[of], name[which], len(entries))
                entry = np.minimum.reduceat(tie, cut)
                if each:
                    chosen[point] = entry
                else:
                    w = tree.weight[point].astype(np.int64)
                    np.add.at(count, entry, w)
                    np.add.at(total, entry, tree.points[point].astype(np.int64) * w[:, None])
            inner = open_[~leaf]
            many = tree.children[inner]
            below.append(_ragged(tree.child[inner], many).astype(np.int64))
            below_mask.append(np.repeat(rest[~leaf], many, axis=0))
        node, mask = np.concatenate(below), np.concatenate(below_mask)
    if not each:
        return count, total
    d2 = ((tree.points.astype(np.int64) - entries[chosen]) ** 2).sum(axis=1)
    return chosen[tree.row], d2[tree.row]


def planted(rows: DataFrame, size: int, parts: int) -> DataFrame:
    """(ids, labels, trees) per batch: one cover tree per part position."""
    width = -(-size // parts)
    label = rows.schema["more_label"].dataType
    arrow_label = to_arrow_type(label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CHUNK // size)
        for whole in batches:
            for b in (whole.slice(k, step) for k in range(0, whole.num_rows, step)):
                x = np.zeros((b.num_rows, width * parts), np.int64)
                x[:, :size] = matrix(b.column("x"), size)
                trees = [tuple(build(x[:, p * width:(p + 1) * width])) for p in range(parts)]
                one = np.array([0, b.num_rows], np.int32)
                ids = b.column("vec_id").cast(pa.int64())
                labels = b.column("more_label").cast(arrow_label)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, labels),
                     pa.array([pickle.dumps(trees, 5)], pa.binary())], ["ids", "labels", "trees"])

    return rows.select("vec_id", "more_label", "x").mapInArrow(
        run, f"ids array<long>, labels array<{label.simpleString()}>, trees binary")


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one Lloyd round over all trees."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for b in batches:
            for raw in b.column("trees"):
                for p, tree in enumerate(pickle.loads(raw.as_py())):
                    n, s = nearest(Tree(*tree), books[p])
                    total[p, :, 0] += n
                    total[p, :, 1:] += s
        used = np.flatnonzero(np.repeat(total[:, :, 0].reshape(-1) > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.reshape(-1)[used])], ["at", "s"])

    sums = trees.select("trees").mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    total = np.zeros(parts * entries * (width + 1), np.int64)
    total[sums["at"].to_numpy()] = sums["s"].to_numpy()
    total = total.reshape(parts, entries, width + 1)
    n = total[:, :, :1]
    return np.where(n > 0, total[:, :, 1:] // np.maximum(n, 1), books)


def first_entries(rows: DataFrame, size: int, parts: int, entries: int) -> np.ndarray:
    """Parts of the rows with the least ids: (parts, entries, width)."""
    some = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    x = np.zeros((len(some), -(-size // parts) * parts), np.int64)
    for k, r in enumerate(some):
        x[k, :size] = r["x"]
    return x.reshape(len(some), parts, -1).swapaxes(0, 1).copy()


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code array<int>, error), codebooks). One row per kept row."""
    rows, size = integer_vectors(df.withColumn("label", F.col(label_col)), id_col, vector_col, "label")
    out = f"vec_id long, label {rows.schema['more_label'].dataType.simpleString()}, code array<int>, error long"
    spark = df.sparkSession
    if not size:
        return spark.createDataFrame([], out).withColumnRenamed("vec_id", id_col), np.zeros((parts, 0, 0), np.int64)
    trees = staged(planted(rows, size, parts), "op12-trees")
    books = first_entries(rows, size, parts, entries)
    for _ in range(rounds):
        books = _round(trees, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                code, error = [], 0
                for p, tree in enumerate(pickle.loads(b.column("trees")[k].as_py())):
                    chosen, d2 = nearest(Tree(*tree), books[p], each=True)
                    code.append(chosen)
                    error = error + d2
                code = np.stack(code, axis=1).astype(np.int32)
                cut = np.arange(len(code) + 1, dtype=np.int32) * parts
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[k].values, b.column("labels")[k].values,
                     pa.ListArray.from_arrays(cut, pa.array(code.reshape(-1))), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, out).withColumnRenamed("vec_id", id_col), books


def coded(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every kept row."""
    found, books = encode(df, id_col, vector_col, label_col)
    found = staged(found, "op12-codes")
    per_label = staged(found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "op12-labels")
    joined = found.join(small_side(per_label), F.col("label").eqNullSafe(F.col("of")))
    hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return joined.select(id_col, hexed.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
