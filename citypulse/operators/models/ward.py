"""Ward linkage over mergeable micro-clusters.

Every partition keeps a bounded number of clustering features (count, sum,
square sum): rows are folded into the nearest feature while its radius stays
below a threshold, and the threshold grows when there are too many (Zhang et
al., 1996). The features of all partitions are folded together in the same way
by one more task, and the hierarchy is built over them by nearest-neighbour
chains with the Lance-Williams update. With at most ``micro`` distinct rows
every feature is one distinct row, and the result is exact Ward linkage.

Memory is ``micro`` features per task and ``micro`` squared distances in the
one task that builds the hierarchy, whatever the table's size.

Heights are those of Ward's minimum-variance criterion on distances, sqrt(2 *
increase of the sum of squares). Ties go to the earlier pair. Rows with a
missing coordinate have no cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.operators.materialize import stage

MICRO = 512


def fold(n: np.ndarray, s: np.ndarray, q: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``limit`` clustering features from more of them; equal rows
    always meet. The radius threshold starts at zero and grows until they fit."""
    centre = s / n[:, None]
    _, first, back = np.unique(centre.round(12), axis=0, return_index=True, return_inverse=True)
    back = back.reshape(-1)
    order = np.argsort(first)  # features keep the order of their first rows
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    to = rank[back]

    def gathered(to: np.ndarray, n, s, q):
        size = to.max() + 1
        total = np.zeros((size, s.shape[1]))
        np.add.at(total, to, s)
        return np.bincount(to, n, size), total, np.bincount(to, q, size)

    n, s, q = gathered(to, n, s, q)
    reach = 0.0
    while len(n) > limit:
        centre = s / n[:, None]
        if reach == 0:  # the scale at which the volume would hold ``limit`` features
            spread = centre.max(axis=0) - centre.min(axis=0)
            reach = float(np.sqrt((spread ** 2).sum())) / limit
        to = np.full(len(n), -1)
        heads: list[int] = []
        left = np.arange(len(n))
        while len(left):  # greedy cover: each pass takes one centre's surroundings
            d = ((centre[left] - centre[left[0]]) ** 2).sum(axis=1)
            near = d <= reach * reach
            to[left[near]] = len(heads)
            heads.append(int(left[0]))
            left = left[~near]
        n, s, q = gathered(to, n, s, q)
        reach *= 1.5
    return n, s, q


def linkage(n: np.ndarray, s: np.ndarray) -> list[tuple[int, int, float, float]]:
    """(left, right, height, size) merges in order of height; features are
    numbered from 0, merge k is number len(n) + k."""
    m = len(n)
    if m < 2:
        return []
    centre = s / n[:, None]
    square = ((centre[:, None] - centre[None]) ** 2).sum(axis=2)
    # squared height of merging i and j: 2 n_i n_j / (n_i + n_j) * distance squared
    d = 2 * n[:, None] * n[None] / (n[:, None] + n[None]) * square
    np.fill_diagonal(d, np.inf)
    size, alive = n.astype(float).copy(), np.ones(m, bool)
    chain: list[int] = []
    found: list[tuple[float, int, int]] = []
    for _ in range(m - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            i = chain[-1]
            row = np.where(alive, d[i], np.inf)
            j = int(np.argmin(row))
            if len(chain) > 1 and row[chain[-2]] <= row[j]:
                j = chain[-2]
            if len(chain) > 1 and j == chain[-2]:
                break
            chain.append(j)
        chain.pop()
        chain.pop()
        a, b = min(i, j), max(i, j)
        found.append((float(d[a, b]), a, b))
        # Lance-Williams: distances of the united cluster from those of its halves
        k = np.flatnonzero(alive)
        k = k[(k != a) & (k != b)]
        total = size[a] + size[b] + size[k]
        new = ((size[a] + size[k]) * d[a, k] + (size[b] + size[k]) * d[b, k] - size[k] * d[a, b]) / total
        d[a, k] = d[k, a] = new
        alive[b] = False
        d[b], d[:, b] = np.inf, np.inf
        size[a] += size[b]
    # merges are found in chain order; by height they form the tree
    name, mass, out = list(range(m)), n.astype(float).tolist(), []
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for height, a, b in sorted(found, key=lambda x: x[0]):
        a, b = sorted((root(a), root(b)))
        left, right = sorted((name[a], name[b]))
        mass[a] += mass[b]
        parent[b] = a
        name[a] = m + len(out)
        out.append((left, right, float(np.sqrt(max(height, 0.0))), mass[a]))
    return out


def cut(m: int, merges: Sequence[tuple], k: int) -> np.ndarray:
    """Cluster number per feature after all but the last k - 1 merges, numbered
    by their first features."""
    parent = np.arange(m + len(merges))
    for i, (a, b, *_) in enumerate(merges[:max(0, m - k)]):
        parent[a] = parent[b] = m + i
    top = np.arange(m)
    while (parent[top] != top).any():
        top = parent[top]
    _, first, back = np.unique(top, return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[back.reshape(-1)]


def micro_clusters(df: DataFrame, cols: Sequence[str], micro: int = MICRO) -> DataFrame:
    """(id, n, s array, q): the clustering features of the whole table."""
    cols = list(cols)

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for x in batches:
            v = x[cols].to_numpy(float)
            v = v[~np.isnan(v).any(axis=1)]
            if len(v):
                new = np.ones(len(v)), v, (v ** 2).sum(axis=1)
                held = fold(*(new if held is None else map(np.concatenate, zip(held, new))), micro)
        if held is not None:
            yield pd.DataFrame({"n": held[0], "s": list(held[1]), "q": held[2]})

    def together(x: pd.DataFrame) -> pd.DataFrame:
        x = x.assign(key=x["s"].map(tuple)).sort_values("key")  # the same order on every run
        n, s, q = fold(x["n"].to_numpy(), np.stack(x["s"].to_list()), x["q"].to_numpy(), micro)
        return pd.DataFrame({"id": np.arange(len(n)), "n": n, "s": list(s), "q": q})

    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(per_task, "n double, s array<double>, q double")
    # groups of features are folded level by level: one task never holds more than a few groups
    cores = df.sparkSession.sparkContext.defaultParallelism
    halves = parts.withColumn("g", F.pmod(F.xxhash64("s"), F.lit(max(1, cores)))).groupBy("g").applyInPandas(
        lambda x: together(x)[["n", "s", "q"]], "n double, s array<double>, q double")
    return stage(halves.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(together, "id long, n double, s array<double>, q double"), "micro")


def ward(df: DataFrame, cols: Sequence[str], k: int = 3, micro: int = MICRO) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``ward_cluster``, merges (step, left, right, height, size))."""
    cols = list(cols)
    features = micro_clusters(df, cols, micro)

    def hierarchy(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("id")
        n, s = x["n"].to_numpy(), np.stack(x["s"].to_list())
        merges = linkage(n, s)
        name = cut(len(n), merges, k)
        rows = [("merge", i, a, b, h, m, None) for i, (a, b, h, m) in enumerate(merges)]
        rows += [("feature", i, int(c), None, None, float(m), v / m) for i, (c, m, v) in enumerate(zip(name, n, s))]
        return pd.DataFrame(rows, columns=["kind", "step", "left", "right", "height", "size", "centre"]).astype(
            {"left": "Int64", "right": "Int64"})  # nullable

    built = stage(features.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(
        hierarchy, "kind string, step long, left long, right long, height double, size double, centre array<double>"), "ward")
    merges = built.where("kind = 'merge'").select("step", "left", "right", "height", F.col("size").cast("long").alias("size"))
    named = built.where("kind = 'feature'").select("left", "centre").orderBy("step").collect()  # at most ``micro`` rows
    centres = np.array([r["centre"] for r in named]).reshape(len(named), len(cols))
    names = np.array([r["left"] for r in named], np.int64)

    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for x in batches:
            v = x.to_numpy(float)
            out = np.full(len(v), -1)
            known = np.flatnonzero(~np.isnan(v).any(axis=1))
            for at in np.array_split(known, max(1, -(-len(known) * max(len(centres), 1) // 4_000_000))):
                if len(at) and len(centres):
                    out[at] = names[((v[at, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)]
            yield pd.Series(out).where(out >= 0, None).astype("Int64")

    labelled = df.withColumn("ward_cluster", nearest(F.struct(*[F.col(c).cast("double").alias(c) for c in cols])))
    return labelled, merges
