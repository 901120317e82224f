"""Cell-graph DBSCAN against the textbook version."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_models import plain_dbscan

from citypulse.operators.models import dbscan as D


def labels(spark, x, eps, min_samples, parts=3):
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(x.shape[1])]).assign(zone=np.arange(len(x)))
    out = D.dbscan(spark.createDataFrame(pdf).repartition(parts), list(pdf.columns[:-1]), "zone", eps, min_samples).collect()
    got = {r["zone"]: r["dbscan_label"] for r in out}
    assert len(out) == len(x)
    return [got[i] for i in range(len(x))]


@pytest.mark.parametrize("seed, d, min_samples", [(1, 2, 3), (2, 1, 2), (3, 4, 4), (4, 2, 1)])
def test_equals_the_textbook(spark, seed, d, min_samples):
    r = np.random.RandomState(seed)
    x = np.concatenate([r.normal(0, 0.5, (40, d)), r.normal(4, 0.8, (40, d)), r.uniform(-8, 8, (40, d)),
                        np.repeat(r.normal(0, 3, (3, d)), 6, axis=0)])
    assert labels(spark, x, 1.0, min_samples) == plain_dbscan(x, 1.0, min_samples)


def test_points_on_a_lattice_at_exactly_eps(spark):
    x = np.array([[i * 0.5, j * 0.5] for i in range(7) for j in range(5)] + [[10.0, 10.0], [10.5, 10.0], [30.0, -0.0], [30.0, 0.0]])
    for min_samples in (2, 4, 5):
        assert labels(spark, x, 0.5, min_samples) == plain_dbscan(x, 0.5, min_samples)


def test_a_dense_cell_stays_linear(spark, monkeypatch):
    """A third of the rows in one cell, beside cells that only its far corner
    reaches: staged rows stay in proportion to the input."""
    r = np.random.RandomState(7)
    n = 6000
    x = np.concatenate([r.uniform(0, 0.4, (n // 3, 2)), r.uniform(1.0, 1.3, (n // 3, 2)), r.uniform(-40, 40, (n // 3, 2))])
    written = []
    plain = D.stage

    def counting(df, name="stage"):
        out = plain(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(D, "stage", counting)
    got = labels(spark, x, 1.0, 5)
    assert max(k for _, k in written) <= 2 * n
    # the two dense cells are one cluster: the nearest corners are closer than 1
    assert len({*got[:n // 3], *got[n // 3:2 * n // 3]}) == 1


def test_missing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (4, float("nan"), 1.0), (9, 0.0, 0.1)],
                               "zone long, a double, b double")
    got = {r["zone"]: r["dbscan_label"] for r in D.dbscan(df, ["a", "b"], "zone", 0.5, 2).collect()}
    assert got == {1: 0, 2: 0, 3: -1, 4: -1, 9: 0}
    assert D.dbscan(df.where(F.lit(False)), ["a", "b"], "zone").count() == 0
