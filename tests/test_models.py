import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from citypulse.functions.scalar import easter_sunday
from citypulse.operators.models.isoforest import detect
from citypulse.timeseries.forecast import forecast_series


def test_isolation_forest_ranks_planted_outliers_first(spark):
    rng = np.random.RandomState(0)
    x = rng.normal(0, 1, (1000, 3))
    x[:10] += 8.0
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(rid=np.arange(1000))
    out = detect(spark.createDataFrame(pdf), ["a", "b", "c"], "rid", 0.05, n_trees=100)
    worst = [r["rid"] for r in out.orderBy("anomaly_score").limit(10).collect()]
    assert set(worst) == set(range(10))
    n_anom = out.where("is_anomaly = 1").count()
    assert 45 <= n_anom <= 55


def test_forecast_shape_and_clamp(spark):
    days = pd.date_range("2024-01-01", periods=60, freq="D")
    pdf = pd.DataFrame({"zone_sk": 1, "ds": days.date, "y": 5 + np.sin(np.arange(60) / 3.0)})
    fc = forecast_series(spark.createDataFrame(pdf), ["zone_sk"], "ds", "y", freq="D", horizon=30,
                         scales=[0.05, 0.3], holdout="fifth", min_points=10, weekly=3,
                         lower=0.0, upper=10.0).toPandas()
    assert len(fc) == 90 and (fc.row_type == "forecast").sum() == 30
    assert fc.yhat.between(0, 10).all()
    assert fc.holdout_mae.iloc[0] < 1.0


def test_easter_rule():
    assert easter_sunday(2024) == dt.date(2024, 3, 31)
    assert easter_sunday(2025) == dt.date(2025, 4, 20)


def plain_dbscan(x, eps, min_samples):
    """Textbook labels: clusters by least core point, border points to the least cluster."""
    near = [[j for j in range(len(x)) if np.sum((x[i] - x[j]) ** 2) <= eps * eps] for i in range(len(x))]
    core = [len(n) >= min_samples for n in near]
    root = list(range(len(x)))
    for _ in x:
        for i in range(len(x)):
            if core[i]:
                root[i] = min(root[j] for j in near[i] if core[j])
    names = {r: k for k, r in enumerate(sorted({root[i] for i in range(len(x)) if core[i]}))}
    return [names[root[i]] if core[i] else min((names[root[j]] for j in near[i] if core[j]), default=-1)
            for i in range(len(x))]


def test_dbscan_against_all_pairs(spark):
    from citypulse.operators.models.dbscan import dbscan
    rng = np.random.RandomState(5)
    x = np.vstack([rng.normal(c, 0.8, (25, 3)) for c in ((0, 0, 0), (6, 0, 0), (-5, 5, 2))] + [rng.uniform(-20, 20, (25, 3))])
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(zone=np.arange(len(x)))
    for min_samples in (2, 4):
        got = {r.zone: r.dbscan_label for r in dbscan(spark.createDataFrame(pdf), ["a", "b", "c"], "zone", 1.5, min_samples).collect()}
        assert [got[i] for i in range(len(x))] == plain_dbscan(x, 1.5, min_samples)


def test_pipeline_and_encoding_persist_roundtrip(spark, tmp_path):
    from pyspark.ml.regression import LinearRegression

    from citypulse.operators.encode import TargetEncoder
    from citypulse.operators.models.common import fit, load, save
    df = spark.createDataFrame([(float(i), float(2 * i + 1), i % 3) for i in range(50)], "x double, y double, k int")
    m = fit(LinearRegression(labelCol="y", featuresCol="features"), df, ["x", "missing_col"])
    save(m, str(tmp_path / "model"))
    back = load(str(tmp_path / "model"))
    a = [r.prediction for r in m.transform(df).orderBy("x").collect()]
    b = [r.prediction for r in back.transform(df).orderBy("x").collect()]
    assert np.allclose(a, b)
    enc = TargetEncoder({"k_mean": ["k"]}, "y").fit(df)
    enc.save(str(tmp_path / "enc"))
    again = TargetEncoder.load(spark, str(tmp_path / "enc"), {"k_mean": ["k"]}, "y")
    new = spark.createDataFrame([(0,), (2,), (9,), (None,)], "k int")
    assert sorted(map(tuple, again.transform(new).collect()), key=str) == sorted(map(tuple, enc.transform(new).collect()), key=str)
