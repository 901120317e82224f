"""Exact Euclidean silhouette (M9).

The mean silhouette needs, per row, its mean distance to every cluster. Rows
are packed into tiles, one Arrow row each; every pair of tiles meets once in an
equi-join of tile numbers (each tile is sent to the others by a list of at most
``tiles`` numbers), and a task turns a pair into distance sums per (row,
cluster) by one matrix product. What is shuffled and summed are those sums,
never pairs of rows. The work is quadratic in the rows all the same, as the
metric is: it is meant for profiles, whose rows are those of a dimension, and
``silhouette`` says so by refusing more than ``MAX_ROWS`` rows; cluster.py has
the squared-Euclidean form that is linear.

Rows alone in their cluster count as 0; fewer than two clusters have no
silhouette. Rows without a label or with a missing coordinate are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.operators.materialize import stage

TILE = 2_048
MAX_ROWS = 1_000_000


def distance_sums(df: DataFrame, cols: Sequence[str], label: str, tile: int = TILE) -> DataFrame:
    """(row, own, other, total): each row's summed distance to each cluster."""
    cols = list(cols)
    rows = stage(df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("long").alias("own"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
        .dropna(), "silhouette-rows")
    n = rows.count()
    if n > MAX_ROWS:
        raise ValueError(f"{n} rows: the Euclidean silhouette compares all pairs; use the squared-Euclidean one")
    tiles = max(1, -(-n // tile))
    vector = F.array(*[f"x{i}" for i in range(len(cols))])
    # a row's number comes from its place in the written stage, so it is stable
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "own", vector.alias("x"))
    numbered = stage(numbered, "silhouette-numbered").withColumn("tile", F.pmod(F.xxhash64("row"), F.lit(tiles)))
    packed = stage(numbered.groupBy("tile").agg(F.collect_list(F.struct("row", "own", "x")).alias("rows")), "tiles")
    left = packed.select("tile", "rows", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("to"))
    right = packed.select(F.col("tile").alias("to"), F.col("rows").alias("others"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for mine, others in zip(b["rows"], b["others"]):
                x, y = (np.array([r["x"] for r in t]) for t in (mine, others))
                near = np.array([r["own"] for r in others])
                names, at = np.unique(near, return_inverse=True)
                d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2)) if len(x) * len(y) * x.shape[1] < 4e6 else \
                    np.stack([np.sqrt(((v - y) ** 2).sum(axis=1)) for v in x])
                total = d @ np.eye(len(names))[at]
                yield pd.DataFrame({"row": np.repeat([r["row"] for r in mine], len(names)),
                                    "own": np.repeat([r["own"] for r in mine], len(names)),
                                    "other": np.tile(names, len(mine)), "total": total.reshape(-1)})

    parts = left.join(right, "to").select("rows", "others").mapInPandas(
        sums, "row long, own long, other long, total double")
    return parts.groupBy("row", "own", "other").agg(F.sum("total").alias("total"))


def silhouette_samples(df: DataFrame, cols: Sequence[str], label: str = "cluster_id", tile: int = TILE) -> DataFrame:
    """(row, own, silhouette) per row."""
    totals = stage(distance_sums(df, cols, label, tile), "silhouette-sums")
    # a cluster's size: how many rows have it as their own, each seen once under its own name
    size = totals.where("own = other").groupBy(F.col("other").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    sized = totals.join(F.broadcast(size), F.col("other") == F.col("c"))  # one row per cluster
    near = F.when(F.col("own") != F.col("other"), F.col("total") / F.col("n"))
    inside = F.when((F.col("own") == F.col("other")) & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))
    per = sized.groupBy("row", "own").agg(F.max(inside).alias("a"), F.min(near).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per.select("row", "own", value.alias("silhouette"))


def silhouette(df: DataFrame, cols: Sequence[str], label: str = "cluster_id", tile: int = TILE) -> float | None:
    """Mean Euclidean silhouette; None for fewer than two clusters."""
    out = silhouette_samples(df, cols, label, tile).agg(
        F.avg("silhouette").alias("s"), F.countDistinct("own").alias("k")).first()
    return float(out["s"]) if out["k"] > 1 else None
