"""Each model recovers what was planted in its input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citypulse.operators.models import cluster as CL
from citypulse.operators.models import supervised as SV
from citypulse.operators.models.common import fit, importances, positive_probability, train_medians
from citypulse.operators.models.svm_rff import RFFSVM
from citypulse.operators.splits import hash_unit, stratified_split
from citypulse.plans.training import fold_f1
from citypulse.sources.sinks import build_report
from citypulse.timeseries.forecast import forecast_series
from citypulse.timeseries.seasonal_arima import seasonal_arima_forecast
from citypulse.timeseries.stationarity import stationarity_tests


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.RandomState(1)
    x = rng.normal(0, 1, (1500, 3))
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["y"] = 3 * x[:, 0] - 2 * (x[:, 1] > 0) + rng.normal(0, 0.1, 1500)
    pdf["k"] = ((x[:, 0] ** 2 + x[:, 1] ** 2) < 1).astype(int)
    pdf["lin"] = (x[:, 0] + x[:, 1] > 0).astype(int)
    pdf["id"] = np.arange(1500)
    pdf.loc[::50, "c"] = np.nan
    return spark.createDataFrame(pdf).withColumn("w", F.lit(1.0)).cache()


def _r2(df, y="y"):
    r = df.select(F.var_pop(y).alias("v"), F.avg(F.pow(F.col(y) - F.col("prediction"), 2)).alias("e")).first()
    return 1 - r["e"] / r["v"]


def _accuracy(df, y):
    return df.select(F.avg((F.col(y) == F.col("prediction")).cast("double"))).first()[0]


def test_boosted_regression_and_importance(planted):
    model = fit(SV.gbt_regressor("y", 60, 4, 0.2), planted, ["a", "b", "c"])
    assert _r2(model.transform(planted)) > 0.95
    top = [r.feature for r in importances(model, ["a", "b", "c"]).collect()]
    assert top[0] == "a" and top[-1] == "c"


def test_boosted_and_forest_classifiers(planted):
    for est in (SV.gbt_classifier("k", "w", 30), SV.random_forest("k", "w", 40, 12)):
        out = positive_probability(fit(est, planted, ["a", "b", "c"]).transform(planted))
        assert _accuracy(out, "k") > 0.95
        assert out.where("proba < 0 or proba > 1").count() == 0


def test_lasso_shrinks_and_logistic_separates(planted):
    strong = fit(SV.lasso("y", 0.5), planted, ["a", "b", "c"]).stages[-1].coefficients
    weak = fit(SV.lasso("y", 0.001), planted, ["a", "b", "c"]).stages[-1].coefficients
    assert abs(strong[0]) < abs(weak[0]) and strong[2] == 0 and abs(weak[0] - 3) < 0.2
    assert _accuracy(fit(SV.logistic_balanced("lin", "w", 1500), planted, ["a", "b"]).transform(planted), "lin") > 0.97


def test_rff_svm_learns_a_circle(planted):
    df = planted.withColumn("label", F.col("k").cast("double"))
    out = RFFSVM(["a", "b"], "label", "w", n_features=128, reg=0.001).fit(df).transform(df)
    assert out.select(F.avg((F.col("svm_pred") == F.col("label")).cast("double"))).first()[0] > 0.9


def test_imputer_learns_exact_training_medians(planted):
    want = planted.toPandas()[["a", "b", "c"]].median()
    got = train_medians(planted, ["a", "b", "c"])
    assert all(abs(got[c] - want[c]) < 1e-12 for c in want.index)


def test_cross_validation_prefers_the_better_grid_point(planted):
    df = planted.withColumn("fold", F.pmod("id", F.lit(3)))
    est = SV.gbt_regressor("y", step=0.3)
    grid = [{est.maxIter: 2}, {est.maxIter: 25}]
    avg, std = SV.cross_validate_fixed_folds(est, df, ["a", "b", "c"], "y", "fold", grid)
    assert avg[1] < avg[0] and len(std) == 2
    table = SV.grid_table(df.sparkSession, ["rounds"], [(2,), (25,)], avg, std).orderBy("rounds").collect()
    assert [r.best for r in table] == [0, 1]


def test_kmeans_elbow_falls_and_rejects_too_large_k(spark):
    rng = np.random.RandomState(2)
    x = np.vstack([rng.normal(m, 0.2, (20, 2)) for m in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]))
    k, _, assigned, table = CL.choose_k(df, ["a", "b"], [2, 3, 4, 60], n_init=3)
    rows = {r.k: r for r in table.collect()}
    assert k == 3 and rows[2].inertia > rows[3].inertia > rows[4].inertia
    assert rows[60].inertia is None and rows[60].status.startswith("rejected")
    sizes = [r[1] for r in CL.hierarchical_clusters(df, ["a", "b"], 3).groupBy("ward_cluster").count().collect()]
    assert sorted(sizes) == [20, 20, 20]


def test_pca_keeps_the_dominant_direction(spark):
    rng = np.random.RandomState(3)
    t = rng.normal(0, 3, 300)
    pdf = pd.DataFrame({"a": t + rng.normal(0, .1, 300), "b": t, "c": rng.normal(0, .5, 300)})
    pdf -= pdf.mean()
    out = CL.pca2(spark.createDataFrame(pdf), ["a", "b", "c"]).toPandas()
    assert out.pc1.var() > 0.95 * pdf.var().sum() and out.pc1.var() > out.pc2.var()


def _series(spark, values, key=1, start="2020-01-01", freq="D"):
    days = pd.date_range(start, periods=len(values), freq=freq)
    return spark.createDataFrame(pd.DataFrame({"zone_sk": key, "ds": days.date, "y": values}))


def test_stationarity_tells_noise_from_a_random_walk(spark):
    rng = np.random.RandomState(4)
    noise, walk = rng.normal(0, 1, 300), np.cumsum(rng.normal(0, 1, 300))
    df = _series(spark, noise, 1).unionByName(_series(spark, walk, 2)).unionByName(_series(spark, noise[:5], 3))
    r = {x.zone_sk: x for x in stationarity_tests(df, ["zone_sk"], "ds", "y").collect()}
    assert r[1].adf_stationary == 1 and r[1].kpss_stationary == 1
    assert r[2].adf_stationary == 0 and r[2].kpss_stationary == 0
    assert r[3].adf_stat is None and r[3].status.startswith("too short") and r[3].n == 5


def test_seasonal_forecast_follows_the_season_and_keeps_short_series(spark):
    t = np.arange(96)
    y = 10 + 0.1 * t + 4 * np.sin(2 * np.pi * t / 12) + np.random.RandomState(5).normal(0, .05, 96)
    df = _series(spark, y, 1, freq="MS").unionByName(_series(spark, y[:9], 2, freq="MS"))
    out = seasonal_arima_forecast(df, ["zone_sk"], "ds", "y").collect()
    good = sorted((r.step, r.forecast) for r in out if r.zone_sk == 1)
    want = [10 + 0.1 * k + 4 * np.sin(2 * np.pi * k / 12) for k in (96, 97, 98)]
    assert np.allclose([f for _, f in good], want, atol=0.5)
    short = [r for r in out if r.zone_sk == 2]
    assert len(short) == 1 and short[0].forecast is None and short[0].status.startswith("too short")


def test_forecast_has_yearly_term_on_short_spans_and_named_holidays(spark):
    days = pd.date_range("2021-01-01", periods=400, freq="D")
    y = np.full(400, 5.0)
    y[[100, 300]] += 3  # one name
    y[[50, 250]] -= 2   # another
    df = _series(spark, y, 1, "2021-01-01").unionByName(_series(spark, y[:4], 2, "2021-01-01"))
    hol = [(days[100].date(), "up"), (days[300].date(), "up"), (days[50].date(), "down"), (days[250].date(), "down"),
           (days[-1].date() + pd.Timedelta(days=3), "up")]
    fc = forecast_series(df, ["zone_sk"], "ds", "y", freq="D", horizon=5, scales=[0.05], holdout="fifth",
                         min_points=10, yearly=2, weekly=1, holidays=hol, lower=None).toPandas()
    one = fc[fc.zone_sk == 1].sort_values("ds").reset_index(drop=True)
    assert one.yhat[300] > 5.8 and one.yhat[250] < 4.7 and abs(one.yhat[200] - 5) < 0.4
    assert one.yhat[402] > one.yhat[401] + 0.5
    two = fc[fc.zone_sk == 2]
    assert len(two) == 1 and two.status.iloc[0].startswith("rejected")


def test_fold_f1_equals_sklearn_definition(spark):
    rng = np.random.RandomState(6)
    pdf = pd.DataFrame({"fold": rng.randint(0, 3, 200), "severity_class": rng.randint(0, 3, 200), "pred": rng.randint(0, 3, 200)})
    got = {r.fold: r.f1_macro for r in fold_f1(spark.createDataFrame(pdf)).collect()}
    for f, g in pdf.groupby("fold"):
        f1 = [2 * ((g.severity_class == c) & (g.pred == c)).sum() / ((g.severity_class == c).sum() + (g.pred == c).sum())
              for c in range(3)]
        assert got[f] == pytest.approx(np.mean(f1))


def test_a_failing_section_hides_no_other(spark):
    rows = {r.section: r for r in build_report(spark, {
        "good": lambda: spark.range(1).select(F.lit(1).alias("x")),
        "bad": lambda: spark.range(1).select(F.raise_error(F.lit("boom")).alias("x")),
        "empty": lambda: spark.range(0)}).collect()}
    assert rows["good"].status == "OK" and rows["bad"].status == "FAILED" and "boom" in rows["bad"].error
    assert rows["empty"].status == "FAILED" and rows["good"].overall == "PARTIAL"


def test_split_seeds_are_independent(spark):
    u = spark.range(100_000).select(hash_unit("id", 42).alias("a"), hash_unit("id", 7).alias("b"), hash_unit(
        F.col("id") + F.lit(2 ** 31).cast("long"), 42).alias("c"))
    r = u.agg(F.avg((F.col("a") < .2).cast("int")).alias("a"), F.avg((F.col("b") < .1).cast("int")).alias("b"),
              F.avg(((F.col("a") < .2) & (F.col("b") < .1)).cast("int")).alias("ab"),
              F.avg((F.col("a") == F.col("c")).cast("int")).alias("same"), F.corr("a", "b").alias("r")).first()
    assert abs(r["a"] - .2) < .01 and abs(r["b"] - .1) < .01 and abs(r["ab"] - .02) < .003
    assert r["same"] < .001 and abs(r["r"]) < .02


def test_stratified_split_keeps_null_labels_and_falls_back(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("y"))
    s = stratified_split(df, "y", "id").groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("is_test").alias("t"))
    assert {r.y: (r.n, r.t) for r in s.collect()} == {None: (200, 40), 0: (400, 80), 1: (400, 80)}
    lone = df.withColumn("y", F.when(F.col("id") == 3, 9).otherwise(0))
    out = stratified_split(lone, "y", "id")
    assert {r[0] for r in out.select("split_mode").distinct().collect()} == {"random"} and out.count() == 1000
