"""Ward linkage and the Euclidean silhouette against plain versions."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citypulse.operators.encode import pop_standardize
from citypulse.operators.models import silhouette as S
from citypulse.operators.models import ward as W
from test_golden_clusters import FEATS, GOLDEN_PROFILE


def plain_ward(x):
    """Heights and the partitions after every merge, by trying all pairs."""
    groups = [[i] for i in range(len(x))]
    cost = lambda g: ((x[g] - x[g].mean(axis=0)) ** 2).sum()
    heights, states = [], [{frozenset(g) for g in groups}]
    while len(groups) > 1:
        best = min(itertools.combinations(range(len(groups)), 2),
                   key=lambda p: round(cost(groups[p[0]] + groups[p[1]]) - cost(groups[p[0]]) - cost(groups[p[1]]), 9))
        a, b = groups[best[0]], groups[best[1]]
        heights.append(np.sqrt(2 * max(cost(a + b) - cost(a) - cost(b), 0)))
        groups = [g for i, g in enumerate(groups) if i not in best] + [a + b]
        states.append({frozenset(g) for g in groups})
    return heights, states


def test_ward_equals_exhaustive_merging():
    r = np.random.RandomState(3)
    for n in (2, 7, 40):
        x = r.normal(0, 1, (n, 3))
        merges = W.linkage(np.ones(n), x)
        heights, states = plain_ward(x)
        assert np.allclose([m[2] for m in merges], heights, atol=1e-6)
        for k in range(1, n + 1):
            name = W.cut(n, merges, k)
            assert {frozenset(np.flatnonzero(name == c)) for c in range(k)} == states[n - k]


def golden(spark):
    df = spark.createDataFrame(GOLDEN_PROFILE, ["zone_sk", "cluster_id", *FEATS])
    return pop_standardize(df, FEATS), [f"{c}_scaled" for c in FEATS]


def test_ward_on_the_golden_profile(spark):
    df, cols = golden(spark)
    out, merges = W.ward(df, cols, 3)
    pdf = out.toPandas().sort_values("zone_sk")
    heights, states = plain_ward(pdf[cols].to_numpy())
    assert np.allclose([r["height"] for r in merges.orderBy("step").collect()], heights)
    got = {frozenset(np.flatnonzero((pdf["ward_cluster"] == c).to_numpy())) for c in range(3)}
    assert got == states[len(pdf) - 3]


def test_ward_over_micro_clusters(spark):
    r = np.random.RandomState(5)
    x = np.concatenate([r.normal(c, 0.3, (3000, 2)) for c in ((0, 0), (8, 0), (0, 9))])
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(truth=np.repeat([0, 1, 2], 3000))
    df = spark.createDataFrame(pdf).repartition(6).union(spark.createDataFrame([(None, 1.0, 9)], "a double, b double, truth long"))
    features = W.micro_clusters(df, ["a", "b"], 40)
    stats = features.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("s")[0]).alias("s")).first()
    assert stats["n"] == 9000 and stats["k"] <= 40 and stats["s"] == pytest.approx(x[:, 0].sum())
    out, merges = W.ward(df, ["a", "b"], 3, 40)
    seen = {(r["truth"], r["ward_cluster"]) for r in out.select("truth", "ward_cluster").distinct().collect()}
    assert len(seen) == 4 and (9, None) in seen and len({c for _, c in seen}) == 4
    assert merges.orderBy(F.desc("height")).first()["size"] == 9000


def test_ward_degenerate(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, None)], "i int, a double")
    out, merges = W.ward(df, ["a"], 3)
    assert {r["i"]: r["ward_cluster"] for r in out.collect()} == {1: 0, 2: 0, 3: None} and merges.count() == 0
    out, merges = W.ward(df.where("false"), ["a"], 3)
    assert out.count() == 0 and merges.count() == 0


def plain_silhouette(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, c in enumerate(label):
        own = label == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == o].mean() for o in set(label) if o != c)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_golden_silhouette(spark):
    df, cols = golden(spark)
    assert S.silhouette(df, cols) == pytest.approx(0.2419, abs=1e-4)  # the published value


@pytest.mark.parametrize("tile", [7, 64, 4096])
def test_silhouette_against_all_pairs(spark, tile):
    r = np.random.RandomState(2)
    x = np.concatenate([r.normal(0, 1, (90, 3)), np.zeros((20, 3))]).round(2)
    label = r.randint(0, 4, 110)
    label[0] = 9  # alone in its cluster
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(cluster_id=label))
    df = df.union(spark.createDataFrame([(None, 0.0, 0.0, 1), (0.0, 0.0, 0.0, None)], df.schema))
    assert S.silhouette(df, list("abc"), tile=tile) == pytest.approx(plain_silhouette(x, label))
    assert S.silhouette(df.where("cluster_id = 1"), list("abc")) is None
