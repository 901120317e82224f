"""Isolation forest (Liu, Ting & Zhou 2008), distributed.

MLlib has none. The work splits the way the algorithm does:

* **Subsampling** - each tree sees ``psi = min(max_samples, n)`` rows. Every
  row draws, from a hash of (row id, tree id), the trees it is offered to
  (Bernoulli with rate ``4 psi / n``), and each tree keeps the ``psi``
  offered rows with the smallest hash. Only about ``4 psi`` rows per tree
  are ever shuffled, whatever the table size.
* **Building** - ``groupBy(tree_id).applyInPandas``: one task per tree, each
  on at most ~``4 psi`` rows, random axis-aligned splits to depth
  ``ceil(log2 psi)``.
* **Scoring** - the forest is a table of ``n_trees x (2 psi - 1)`` nodes at
  most (bounded by the parameters, not the data: 300 x 511 by default); it is
  broadcast and every partition scores its rows with a vectorised
  ``mapInPandas`` descent (Arrow batches, no per-row Python).
* **Threshold** - offset = exact ``contamination`` quantile of the scores
  (``exact_quantiles``); decision = -score - offset, anomaly when < 0
  (the sklearn conventions).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.operators.ordered import exact_quantiles
from citypulse.operators.splits import hash_unit

EULER = 0.5772156649015329
NODE_SCHEMA = ("tree_id long, node_id long, feature long, threshold double, "
               "left long, right long, size long, depth long")


def avg_path_length(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _build_tree(pdf: pd.DataFrame, features: list[str], max_depth: int, seed: int) -> pd.DataFrame:
    tree_id = int(pdf["tree_id"].iloc[0])
    rng = np.random.RandomState((seed * 1000003 + tree_id) % (2 ** 31))
    x = pdf[features].to_numpy(dtype=float)
    nodes = []

    def grow(idx: np.ndarray, depth: int) -> int:
        node_id = len(nodes)
        nodes.append(None)
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[node_id] = (tree_id, node_id, -1, 0.0, -1, -1, len(idx), depth)
            return node_id
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            nodes[node_id] = (tree_id, node_id, -1, 0.0, -1, -1, len(idx), depth)
            return node_id
        q = int(rng.choice(cand))
        thr = float(rng.uniform(lo[q], hi[q]))
        go_left = sub[:, q] < thr
        left = grow(idx[go_left], depth + 1)
        right = grow(idx[~go_left], depth + 1)
        nodes[node_id] = (tree_id, node_id, q, thr, left, right, len(idx), depth)
        return node_id

    grow(np.arange(len(x)), 0)
    return pd.DataFrame(nodes, columns=["tree_id", "node_id", "feature", "threshold", "left",
                                        "right", "size", "depth"])


class IsolationForestModel:
    def __init__(self, nodes: pd.DataFrame, features: list[str], psi: int):
        self.features = features
        self.psi = psi
        self.nodes = nodes

    def score(self, df: DataFrame, out: str = "iso_score") -> DataFrame:
        """Anomaly score 2^(-E[h(x)] / c(psi)) in (0, 1]; higher = more anomalous."""
        spark = df.sparkSession
        arrays = {}
        for tid, g in self.nodes.groupby("tree_id"):
            g = g.sort_values("node_id")
            arrays[int(tid)] = (g["feature"].to_numpy(), g["threshold"].to_numpy(),
                                g["left"].to_numpy(), g["right"].to_numpy(),
                                (g["depth"] + avg_path_length(g["size"])).to_numpy())
        bc = spark.sparkContext.broadcast(arrays)
        feats = self.features
        c_psi = float(avg_path_length([self.psi])[0]) or 1.0
        schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.DoubleType())])

        def score_batches(it):
            forest = bc.value
            for pdf in it:
                x = pdf[feats].to_numpy(dtype=float)
                total = np.zeros(len(x))
                for feat, thr, left, right, leaf_len in forest.values():
                    node = np.zeros(len(x), dtype=np.int64)
                    active = feat[node] >= 0
                    while active.any():
                        f = feat[node[active]]
                        go_left = x[np.flatnonzero(active), f] < thr[node[active]]
                        node[active] = np.where(go_left, left[node[active]], right[node[active]])
                        active = feat[node] >= 0
                    total += leaf_len[node]
                pdf[out] = np.power(2.0, -(total / len(forest)) / c_psi)
                yield pdf

        return df.mapInPandas(score_batches, schema)


def fit_isolation_forest(df: DataFrame, features: Sequence[str], id_col: str,
                         n_trees: int = 300, max_samples: int = 256, seed: int = 42,
                         oversample: float = 4.0) -> IsolationForestModel:
    features = list(features)
    n = df.count()
    psi = int(min(max_samples, n))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    rate = min(1.0, oversample * psi / max(n, 1))
    base = df.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(c) for c in features])
    # a row is offered to the few trees it can expect to reach, spread over all
    # trees from a random start, instead of being drawn for every tree
    turns = max(1, math.ceil(rate * n_trees))
    step = next(k for k in range(max(1, int(0.618 * n_trees)), 0, -1) if math.gcd(k, n_trees) == 1)
    offered = base.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))).where(
        hash_unit(F.xxhash64(F.col("_id"), F.col("_t"), F.lit(seed)), 11) < rate * n_trees / turns)
    offered = offered.withColumn("tree_id", F.pmod(
        F.pmod(F.xxhash64(F.col("_id"), F.lit(seed + 2)), F.lit(n_trees)) + F.col("_t") * step,
        F.lit(n_trees)).cast("int")).drop("_t")
    offered = offered.withColumn("_h", F.xxhash64(F.col("_id"), F.col("tree_id"), F.lit(seed + 1)))
    from pyspark.sql import Window
    w = Window.partitionBy("tree_id").orderBy("_h", "_id")
    sample = offered.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi)
    nodes = (sample.drop("_r", "_h", "_id").groupBy("tree_id")
             .applyInPandas(lambda pdf: _build_tree(pdf, features, max_depth, seed), NODE_SCHEMA))
    # bounded by the parameters (n_trees x (2 psi - 1) rows): safe to bring back and broadcast
    return IsolationForestModel(nodes.toPandas(), features, psi)


def detect(df: DataFrame, features: Sequence[str], id_col: str, contamination: float = 0.05,
           n_trees: int = 300, max_samples: int = 256, seed: int = 42) -> DataFrame:
    """Fit, score, threshold. Adds ``anomaly_score`` (sklearn decision
    function: negative = anomalous), ``is_anomaly`` and ``anomaly_label``."""
    model = fit_isolation_forest(df, features, id_col, n_trees, max_samples, seed)
    scored = model.score(df).withColumn("_ss", -F.col("iso_score"))
    off = exact_quantiles(scored, "_ss", {"off": contamination}).select("off").scalar()
    out = scored.withColumn("anomaly_score", F.col("_ss") - off).drop("_ss", "iso_score")
    out = out.withColumn("is_anomaly", (F.col("anomaly_score") < 0).cast("int"))
    # The reference's alert labels.
    return out.withColumn("anomaly_label", F.when(F.col("is_anomaly") == 1,
                                                  F.lit("Alert — abnormal spike"))
                          .otherwise(F.lit("Normal")))
