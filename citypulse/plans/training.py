"""Model stages of the three plans. Each returns a small report DataFrame
(metrics, labels, forecasts); fitted models can be saved with
``operators.models.common.save``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions import scalar as S
from citypulse.operators import curves as CU
from citypulse.operators import metrics as MT
from citypulse.operators import splits as SP
from citypulse.operators.clean import resolve_features, threshold_band
from citypulse.operators.encode import TargetEncoder, pop_standardize
from citypulse.operators.materialize import materialize, stage
from citypulse.operators.models import boosting as B
from citypulse.operators.models import cluster as CL
from citypulse.operators.models import isoforest as ISO
from citypulse.operators.models import supervised as SV
from citypulse.operators.models.common import fit, importances, positive_probability
from citypulse.operators.models.svm_rff import RFFSVM
from citypulse.operators.models.ward import ward
from citypulse.plans import ecology as E
from citypulse.plans import mobility as M
from citypulse.plans import safety as SF
from citypulse.sources.warehouse import TERRITORIAL_ORDER
from citypulse.timeseries.forecast import forecast_series
from citypulse.timeseries.seasonal_arima import seasonal_arima_forecast
from citypulse.timeseries.stationarity import stationarity_tests

# The reference's model feature lists.
ECO_FEATURES_COMBINED = [
    "zone_encoded", "mode_encoded", "mode_co2_mean", "annee", "mois_sin", "mois_cos",
    "pm25", "no2", "aqi_index", "co2_lag1", "co2_lag3", "energie_lag1", "energie_lag3",
    "aqi_lag1", "pm25_lag1", "co2_roll3", "energie_roll3", "pm25_roll3",
]
ECO_FEATURES_PER_MODE = [c for c in ECO_FEATURES_COMBINED if c not in ("mode_encoded", "mode_co2_mean")]
MOB_LOAD_FEATURES = [
    "zone_encoded", "line_encoded", "mode_encoded", "hour", "rush_hour", "is_weekend",
    "congestion_index", "vitesse_kmh", "temps_trajet_min", "line_charge_mean",
    "zone_hour_charge", "hour_x_congestion", "weekend_x_zone",
]
MOB_CLS_FEATURES = ["zone_encoded", "line_encoded", "mode_encoded", "hour", "rush_hour",
                    "is_weekend", "congestion_index", "charge_estimee"]
# The reference's boosting parameters.
ECO_BOOST = dict(rounds=300, depth=4, step=0.03, subsample=0.8, colsample=0.8, min_child_weight=5, gamma=0.05,
                 reg_alpha=0.3, reg_lambda=1.5)
ECO_PATIENCE = 30
LOAD_BOOST = dict(rounds=300, depth=6, step=0.05, subsample=0.8, colsample=0.8, min_child_weight=3, reg_alpha=0.1,
                  reg_lambda=1.0)
CANCELLATION_BOOST = dict(rounds=300, depth=5, step=0.05, subsample=0.8, colsample=0.8, min_child_weight=3)
SAFE_FEATURES = ["zone_encoded", "mode_encoded", "annee", "mois", "volume_crimes",
                 "taux_criminalite", "usagers_vulnerables", "crime_rate_scaled"]
SAFE_LEAKY = ["has_accident", "gravite_index"]
SAFE_CLUSTER = ["nb_accidents", "nb_graves", "volume_crimes", "taux_criminalite",
                "usagers_vulnerables"]


def _metric_row(name: str, m: DataFrame) -> DataFrame:
    return m.select(F.lit(name).alias("model"), "n", "rmse", "mae", "r2")


# -- ecology ------------------------------------------------------------------

def eco_training_frame(features: DataFrame) -> DataFrame:
    """X1 split, with the positional fallback when no month is late enough to
    test on + E2/Q3: ``mode_co2_mean`` re-learnt on the training months
    only + Q4: a validation slice carved from the training rows."""
    df = E.temporal_split(features).withColumn("split_mode", F.lit("temporal"))
    if df.where(F.col("is_test") == 1).isEmpty():
        df = SP.positional_split(features, ["annee_mois_dt", "zone_sk", "mode_sk", "time_sk", "fact_impact_sk"])
        df = df.withColumn("split_mode", F.lit("positional"))
    train = df.where(F.col("is_test") == 0)
    enc = TargetEncoder({"mode_co2_mean_tr": ["mode_sk"]}, "co2_kg").fit(train)
    df = enc.transform(df).withColumn("mode_co2_mean", F.col("mode_co2_mean_tr")).drop("mode_co2_mean_tr")
    df = SV.validation_flag(df, "fact_impact_sk")
    return stage(df, "eco-training")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _concurrently(fn, items, workers: int = 6) -> list:
    """Independent fits, submitted from a bounded pool; Spark schedules their jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(items)))) as pool:
        return list(pool.map(fn, items))


def eco_co2_models(features: DataFrame, max_iter: int = 300, min_train: int = 20):
    """L1 + L2: boosted regression of log CO2 with early stopping, combined and
    one model per mode. Returns (scored test rows by model, mode list with
    status): a mode with fewer than ``min_train`` training rows or no test row
    is skipped and says so."""
    df = eco_training_frame(features)
    test = df.where(F.col("is_test") == 1)
    # the distinct modes form a small dimension: one fit per mode, all in shared passes
    sizes = sorted(df.groupBy("mode_sk").agg(F.sum(1 - F.col("is_test")).alias("n_tr"),
                                             F.sum("is_test").alias("n_te")).collect(),
                   key=lambda r: (r["mode_sk"] is None, r["mode_sk"]))
    status = [(r["mode_sk"], int(r["n_tr"]), int(r["n_te"]),
               f"skipped: fewer than {min_train} training rows" if r["n_tr"] < min_train
               else "skipped: no test rows" if r["n_te"] == 0 else "fitted") for r in sizes]
    modes = [None, *[m for m, _, _, s in status if s == "fitted" and m is not None]]

    def spec(mode) -> B.Fit:
        mine = F.lit(True) if mode is None else F.col("mode_sk") == mode
        old = mine & (F.col("is_test") == 0)
        wanted = ECO_FEATURES_COMBINED if mode is None else ECO_FEATURES_PER_MODE
        return B.Fit("co2_log", tuple(resolve_features(df, wanted)), old & ~F.col("is_val"), old & F.col("is_val"),
                     patience=ECO_PATIENCE, **{**ECO_BOOST, "rounds": max_iter})

    models = B.boost(df, [spec(m) for m in modes], "fact_impact_sk")

    def scored(mode, model: B.Boosted) -> DataFrame:
        held = test if mode is None else test.where(F.col("mode_sk") == mode)
        return model.transform(held).select(
            F.lit("combined" if mode is None else "per_mode").alias("model"), "fact_impact_sk", "zone_sk", "mode_sk",
            "time_sk", "annee_mois_dt", "co2_kg", F.expm1("prediction").alias("co2_pred"))

    return _union([scored(*x) for x in zip(modes, models)]), status


def eco_co2_regression(features: DataFrame, max_iter: int = 300, min_train: int = 20) -> DataFrame:
    """L1 + L2 + M1/M2: test metrics on kg of the combined model, of the pooled
    per-mode models and of each mode; skipped modes keep a row with a status."""
    scored, status = eco_co2_models(features, max_iter, min_train)
    scored = stage(scored, "co2-scored")
    metric = lambda d, by=(): MT.regression_metrics(d, "co2_kg", "co2_pred", by=list(by))
    cols = ["n", "rmse", "mae", "r2"]
    pooled = scored.where(F.col("model") == "per_mode")
    named = F.concat(F.lit("mode_"), F.coalesce(F.col("mode_sk").cast("string"), F.lit("none")))
    out = _union([metric(scored.where(F.col("model") == "combined")).select(F.lit("combined").alias("model"), *cols),
                  metric(pooled).select(F.lit("per_mode_pooled").alias("model"), *cols),
                  metric(pooled, ["mode_sk"]).select(named.alias("model"), *cols)])
    modes = features.sparkSession.createDataFrame(
        [(f"mode_{m if m is not None else 'none'}", tr, s) for m, tr, _, s in status],
        "model string, n_train long, status string")
    return out.join(modes, "model", "full").select(
        "model", "n", "rmse", "mae", "r2", "n_train", F.coalesce("status", F.lit("fitted")).alias("status"))


def eco_co2_predictions(features: DataFrame, max_iter: int = 300) -> DataFrame:
    """L14 + IO7: actual and predicted CO2 of every test row, by model."""
    scored, _ = eco_co2_models(features, max_iter)
    return MT.residuals(scored, "co2_kg", "co2_pred")


def eco_tree_grid(features: DataFrame) -> DataFrame:
    """Boosted log-CO2 trees over the reference's 8-point grid, 3 contiguous folds."""
    df = eco_training_frame(features)
    train = SP.contiguous_kfold(df.where(F.col("is_test") == 0),
                                ["zone_sk", "mode_sk", "annee_mois_dt", "time_sk", "fact_impact_sk"], 3)
    # The grid. A fit of fewer rounds is the beginning of a longer one.
    points = [(n, d, lr) for n in (100, 200) for d in (3, 5) for lr in (0.05, 0.1)]
    return _boosted_grid(train, "co2_log", ECO_FEATURES_COMBINED, "fact_impact_sk", ["n_rounds", "max_depth", "step"],
                         points, lambda p: dict(depth=p[1], step=p[2], subsample=0.8, colsample=0.8), 3)


def _boosted_grid(df: DataFrame, label: str, features: list[str], key: str, names: list[str], points: list[tuple],
                  params, k: int) -> DataFrame:
    """X7 + X4: every (grid point, fold) in shared passes; ``points`` begin with
    their rounds, points that differ in them only share a fit."""
    fits = {p[1:]: max(q[0] for q in points if q[1:] == p[1:]) for p in points}
    cols = tuple(resolve_features(df, features))
    specs = [B.Fit(label, cols, F.col("fold") != f, rounds=n, **params((n, *rest)))
             for rest, n in fits.items() for f in range(k)]
    models = B.boost(df, specs, key)
    by_fit = {rest: models[i * k:(i + 1) * k] for i, rest in enumerate(fits)}
    found = B.cv_rmse(df, {f"p{i}": [m.first(p[0]) for m in by_fit[p[1:]]] for i, p in enumerate(points)}, label)
    avg, std = zip(*(found[f"p{i}"] for i in range(len(points))))
    return SV.grid_table(df.sparkSession, names, points, list(avg), list(std))


def eco_correlations(features: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of the measures, one aggregate."""
    cols = [c for c in ("co2_kg", "energie_kwh", "aqi_index", "pm25", "no2") if c in features.columns]
    pairs = [(a, b) for a in cols for b in cols]
    row = features.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("corr"))
                                 for a, b in pairs]).alias("m"))
    return row.select(F.explode("m").alias("m")).select("m.*")


def eco_lasso_grid(features: DataFrame, alphas=(1.0, 0.1)) -> DataFrame:
    """L11 + X7 + X4 + M3: Lasso on log CO2 over an alpha grid with
    contiguous 5-fold CV on the training months; mean/std CV RMSE per alpha."""
    df = eco_training_frame(features)
    train = SP.contiguous_kfold(df.where(F.col("is_test") == 0),
                                ["zone_sk", "mode_sk", "annee_mois_dt", "time_sk", "fact_impact_sk"], 5)
    est, grid = SV.lasso_grid("co2_log", alphas)
    avg, std = SV.cross_validate_fixed_folds(est, train, ECO_FEATURES_COMBINED, "co2_log", "fold", grid)
    spark = df.sparkSession
    rows = [(float(a), float(m), float(std[i]) if std else None) for i, (a, m) in enumerate(zip(alphas, avg))]
    return spark.createDataFrame(rows, "alpha double, cv_rmse_mean double, cv_rmse_std double")


def eco_elbow(features: DataFrame, ks=tuple(range(2, 9))) -> DataFrame:
    """L4 + M9 + M10: silhouette and inertia of each k over the zone pollution
    profile; a k that the profile is too small for says so."""
    prof = E.zone_pollution_profile(features)
    return CL.choose_k(prof, [f"{c}_scaled" for c in E.PROFILE_FEATURES], ks)[3]


def eco_pollution_clusters(features: DataFrame, ks=(2, 3, 4)) -> DataFrame:
    """L4 + L8 + E1 + J3 + M9/M10/M11: zone pollution profiles, k chosen by
    silhouette, centroid-rule names."""
    prof = materialize(E.zone_pollution_profile(features))
    cols = [f"{c}_scaled" for c in E.PROFILE_FEATURES]
    k, model, assigned, table = CL.choose_k(prof, cols, ks)
    cents = assigned.groupBy("cluster_id").agg(*[F.avg(c).alias(c.replace("_scaled", "")) for c in cols])
    named = CL.centroid_rule_labels(cents)
    q = CL.cluster_quality(assigned, cols).first()
    return (assigned.join(named.select("cluster_id", "cluster_label"), "cluster_id")
                    .select("zone_sk", "zone_nom", "cluster_id", "cluster_label", *cols)
                    .withColumn("k", F.lit(k)).withColumn("silhouette", F.lit(q["silhouette"]))
                    .withColumn("inertia", F.lit(q["inertia"]))
                    .withColumn("davies_bouldin", F.lit(q["davies_bouldin"])))


def eco_pca(features: DataFrame) -> DataFrame:
    """First two principal components of the standardised zone profile."""
    prof = materialize(E.zone_pollution_profile(features))
    return CL.pca2(prof, [f"{c}_scaled" for c in E.PROFILE_FEATURES]).select("zone_sk", "pc1", "pc2")


ECO_TARGETS = {"aqi_index": "aqi", "pm25": "pm25", "co2_kg": "co2", "energie_kwh": "nrj"}


def eco_forecasts(clean: DataFrame, horizon: int = 24) -> DataFrame:
    """Y1 + Y3-Y6 + J6: monthly forecasts per (zone, target), tuned scale,
    clipped at 0, tagged historical / forecast, one wide row per (zone, ds,
    row_type) - long format then ``pivot`` rather than a chain of outer joins."""
    m = E.zone_month_targets(clean)
    long = None
    for i, (col, short) in enumerate(ECO_TARGETS.items()):
        part = m.select("zone_sk", "annee_mois_dt", F.lit(i).alias("target_id"), F.col(col).alias("y"))
        long = part if long is None else long.unionByName(part)
    fc = forecast_series(long, ["zone_sk", "target_id"], "annee_mois_dt", "y", freq="MS",
                         horizon=horizon, scales=[0.05, 0.3], holdout="fixed3", min_points=18)
    names = F.create_map(*[x for i, s in enumerate(ECO_TARGETS.values()) for x in (F.lit(i), F.lit(s))])
    fc = fc.withColumn("target", names[F.col("target_id")])
    wide = fc.where(F.col("ds").isNotNull()).groupBy("zone_sk", "ds", "row_type").pivot("target", list(ECO_TARGETS.values())).agg(
        F.first("yhat").alias("forecast"), F.first("yhat_lower").alias("lower"),
        F.first("yhat_upper").alias("upper"))
    return wide


def eco_forecast_summary(clean: DataFrame) -> DataFrame:
    """Y6 + G16 + Y12: per target, mean holdout MAE (honest) and mean
    in-sample last-3 MAE (the reference's number) over zones."""
    m = E.zone_month_targets(clean)
    long = None
    for i, col in enumerate(ECO_TARGETS):
        part = m.select("zone_sk", "annee_mois_dt", F.lit(i).alias("target_id"), F.col(col).alias("y"))
        long = part if long is None else long.unionByName(part)
    fc = forecast_series(long, ["zone_sk", "target_id"], "annee_mois_dt", "y", freq="MS",
                         horizon=1, scales=[0.05, 0.3], holdout="fixed3", min_points=18)
    per = fc.groupBy("zone_sk", "target_id").agg(F.first("holdout_mae").alias("h"),
                                                 F.first("insample_mae").alias("i"))
    names = F.create_map(*[x for i, s in enumerate(ECO_TARGETS.values()) for x in (F.lit(i), F.lit(s))])
    return (per.groupBy("target_id").agg(F.avg("h").alias("holdout_mae_mean"),
                                         F.avg("i").alias("insample_mae_mean"),
                                         F.count(F.lit(1)).alias("n_series"))
               .withColumn("target", names[F.col("target_id")]).drop("target_id"))


def eco_sarima(clean: DataFrame) -> DataFrame:
    """3-step seasonal ARIMA forecasts of each zone's monthly AQI."""
    m = E.zone_month_targets(clean)
    return seasonal_arima_forecast(m, ["zone_sk"], "annee_mois_dt", "aqi_index", steps=3, season=12)


def eco_forecast_comparison(clean: DataFrame) -> DataFrame:
    """M14 + Y12: MAE and MAPE on the last three months of each zone's AQI, for
    the additive forecaster, the seasonal ARIMA and the last value, averaged over
    the zones that the model could hold out."""
    m = E.zone_month_targets(clean).select("zone_sk", "annee_mois_dt", "aqi_index")
    additive = forecast_series(m, ["zone_sk"], "annee_mois_dt", "aqi_index", freq="MS", horizon=1,
                               scales=[0.05, 0.3], holdout="fixed3", min_points=18)
    additive = additive.groupBy("zone_sk").agg(F.max("holdout_mae").alias("mae"), F.max("holdout_mape").alias("mape"))
    seasonal = seasonal_arima_forecast(m, ["zone_sk"], "annee_mois_dt", "aqi_index", steps=1, season=12)
    seasonal = seasonal.select("zone_sk", F.col("holdout_mae").alias("mae"), F.col("holdout_mape").alias("mape"))
    from pyspark.sql import Window
    back = Window.partitionBy("zone_sk").orderBy(F.col("annee_mois_dt").desc())  # one row per month
    known = m.where(F.col("aqi_index").isNotNull()).withColumn("k", F.row_number().over(back)).withColumn(
        "last", F.max(F.when(F.col("k") == 4, F.col("aqi_index"))).over(Window.partitionBy("zone_sk")))
    gap = F.abs(F.col("aqi_index") - F.col("last"))
    naive = known.where("k <= 3").groupBy("zone_sk").agg(
        F.avg(gap).alias("mae"), F.avg(F.when(F.col("aqi_index") > 0, gap / F.col("aqi_index") * 100)).alias("mape"))
    named = [d.withColumn("model", F.lit(n)) for n, d in (("additive", additive), ("seasonal_arima", seasonal),
                                                          ("last_value", naive))]
    ok = _union(named).where(F.col("mae").isNotNull() & ~F.isnan("mae"))
    return ok.groupBy("model").agg(F.avg("mae").alias("mae"), F.avg("mape").alias("mape"),
                                   F.count(F.lit(1)).alias("n_series"))


def eco_future_predictions(features: DataFrame, max_iter: int = 300) -> DataFrame:
    """L15 + L14 + F9: the combined CO2 and energy models (trained on all
    feature rows) scored on the 24-month (zone, mode) scenario grid;
    carbon intensity of the predictions."""
    grid = E.future_grid(features)
    enc = features.groupBy("mode_sk").agg(F.avg("co2_kg").alias("mode_co2_mean"))
    glob = features.agg(F.avg("co2_kg").alias("g")).select("g").scalar()
    grid = grid.join(enc, "mode_sk", "left").withColumn("mode_co2_mean", F.coalesce("mode_co2_mean", glob))
    features = stage(features, "eco-features")
    cols = tuple(resolve_features(features, ECO_FEATURES_COMBINED))
    co2, nrj = B.boost(features, [B.Fit(t, cols, F.lit(True), **{**ECO_BOOST, "rounds": max_iter})
                                  for t in ("co2_log", "energie_log")], "fact_impact_sk")
    p = co2.transform(grid).withColumn("co2_predicted", S.round_half_even(F.expm1("prediction"), 2))
    keep = ["zone_sk", "mode_sk", "annee", "mois", "annee_mois_dt", "co2_predicted"]
    p = p.select(*keep, *[c for c in ECO_FEATURES_COMBINED if c not in keep])
    p = nrj.transform(p).withColumn("energie_predicted", S.round_half_even(F.expm1("prediction"), 2))
    return p.select("zone_sk", "mode_sk", "annee", "mois", "annee_mois_dt", "co2_predicted",
                    "energie_predicted",
                    F.when(F.col("energie_predicted") > 0, S.round_half_even(
                        F.col("co2_predicted") / F.col("energie_predicted"), 4)).alias("carbon_intensity"),
                    F.lit("future").alias("prediction_type"))


# -- mobility -----------------------------------------------------------------

def mob_load_regression(features: DataFrame, max_iter: int = LOAD_BOOST["rounds"]) -> DataFrame:
    """L1 + X2 + E2 + X4/M3 + M1: boosted load regression with leakage-free
    encodings; 5-fold contiguous CV RMSE on the training rows, test metrics.
    The folds' models and the final one grow in the same passes."""
    enc = stage(M.load_encodings(features), "load")
    train, test = enc.where(F.col("is_test") == 0), enc.where(F.col("is_test") == 1)
    folds = stage(SP.contiguous_kfold(train, ["fact_mob_sk"], 5), "load-folds")
    params = {**LOAD_BOOST, "rounds": max_iter}
    cols = tuple(resolve_features(enc, MOB_LOAD_FEATURES))
    fits = [B.Fit("charge_estimee", cols, F.lit(True) if k < 0 else F.col("fold") != k, **params) for k in (-1, *range(5))]
    model, *cv = B.boost(folds, fits, "fact_mob_sk")
    avg, std = B.cv_rmse(folds, {"rmse": cv}, "charge_estimee")["rmse"]
    m = MT.regression_metrics(model.transform(test), "charge_estimee", "prediction")
    return m.select("n", "rmse", "mae", "r2", F.lit(avg).alias("cv_rmse_mean"), F.lit(std).alias("cv_rmse_std"),
                    F.lit(max_iter).alias("rounds"), F.lit(params["depth"]).alias("max_depth"))


def mob_load_predictions(features: DataFrame, max_iter: int = LOAD_BOOST["rounds"]) -> DataFrame:
    """L14 + IO7 + BI5: predicted load of every trip, with its join keys and
    whether the trip was held out of training."""
    enc = stage(M.load_encodings(features), "load")
    model, = B.boost(enc, [B.Fit("charge_estimee", tuple(resolve_features(enc, MOB_LOAD_FEATURES)), F.col("is_test") == 0,
                                 **{**LOAD_BOOST, "rounds": max_iter})], "fact_mob_sk")
    return model.transform(enc).select(
        "fact_mob_sk", "time_sk", "zone_sk", "line_sk", "mode_sk", "charge_estimee",
        F.greatest(F.col("prediction"), F.lit(0.0)).alias("charge_predicted"), "is_test")


def mob_tree_grid(features: DataFrame) -> DataFrame:
    """Boosted load trees over the reference's 4-point grid, 3 contiguous folds."""
    enc = stage(M.load_encodings(features), "load")
    folds = stage(SP.contiguous_kfold(enc.where(F.col("is_test") == 0), ["fact_mob_sk"], 3), "load-folds")
    points = [(n, d) for n in (100, 200) for d in (3, 5)]  # Fixed values: the grid.
    return _boosted_grid(folds, "charge_estimee", MOB_LOAD_FEATURES, "fact_mob_sk", ["n_rounds", "max_depth"], points,
                         lambda p: dict(depth=p[1]), 3)


def _cancellation_model(features: DataFrame, max_iter: int):
    """(model, weighted split) of the cancellation classifier."""
    if features.where(F.col("retard_flag") == 1).isEmpty():
        raise ValueError("no positive rows: cancellation model cannot be trained")
    df = SP.stratified_split(features, "retard_flag", "fact_mob_sk", 0.2, 42)
    df = stage(SV.pos_weight(df, "retard_flag"), "cancellation")
    model, = B.boost(df, [B.Fit("retard_flag", tuple(resolve_features(df, MOB_CLS_FEATURES)), F.col("is_test") == 0,
                                weight="w", objective="logistic", **{**CANCELLATION_BOOST, "rounds": max_iter})],
                     "fact_mob_sk")
    return model, df


def mob_cancellation_predictions(features: DataFrame, max_iter: int = 300) -> DataFrame:
    """L14 + P18 + IO7 + BI5: cancellation probability and risk band of every trip."""
    model, df = _cancellation_model(features, max_iter)
    return model.transform(df, "proba").withColumn("risk_label", threshold_band("proba")).select(
        "fact_mob_sk", "time_sk", "zone_sk", "line_sk", "mode_sk", "retard_flag", "proba", "risk_label", "is_test")


def mob_cancellation(features: DataFrame, max_iter: int = 300) -> DataFrame:
    """L3 + X3 + M5/M7/M8 + W10/W11 + M16 + P18 + L14: weighted boosted
    classifier on a stratified split; AUC, confusion at 0.5, best-F1
    threshold, and the number of trips per risk band."""
    model, df = _cancellation_model(features, max_iter)
    scored = model.transform(df, "proba").withColumn("risk_label", threshold_band("proba"))
    scored = stage(scored.select("retard_flag", "is_test", "proba", "risk_label"), "cancellation-scored")
    held = scored.where(F.col("is_test") == 1)
    auc = CU.roc_auc(held, "retard_flag", "proba").select("auc").scalar()
    at50 = MT.binary_scores(MT.threshold_predictions(held, "proba", 0.5), "retard_flag", "y_pred")
    best = CU.best_f1_threshold(held, "retard_flag", "proba")
    band_counts = scored.groupBy().pivot("risk_label", ["Low", "Medium", "High"]).count()
    return MT.one_row(
        at50.select(auc.alias("auc"), "tp", "fp", "fn", "n", "precision", "recall", "f1"),
        best.select(F.col("threshold").alias("best_threshold"), F.col("f1").alias("best_f1")),
        band_counts.select(F.col("Low").alias("n_low"), F.col("Medium").alias("n_medium"),
                           F.col("High").alias("n_high")))


def mob_logistic(features: DataFrame) -> DataFrame:
    """Balanced logistic regression baseline on the stratified split."""
    df = SP.stratified_split(features, "retard_flag", "fact_mob_sk", 0.2, 42)
    df = materialize(SV.balanced_weights(df, "retard_flag"))
    train, test = df.where(F.col("is_test") == 0), df.where(F.col("is_test") == 1)
    n = train.count()
    model = fit(SV.logistic_balanced("retard_flag", "w", n), train, MOB_CLS_FEATURES)
    s = positive_probability(model.transform(test))
    return CU.roc_auc(s, "retard_flag", "proba")


def mob_congestion_forecast(features: DataFrame, horizon: int = 30) -> DataFrame:
    """Y2 + Y3 + F13 + P15 + W8 + Y6: daily congestion per zone with weekly
    and yearly terms and French public holidays, scale tuned on the last
    min(30, n // 5) days, clamped to [0, 10] (the lower band at 0 only, the
    upper band at 10 only, as in the reference)."""
    daily = M.daily_congestion(features)
    years = daily.agg(F.min(F.year("ds")).alias("a"), F.max(F.year("ds")).alias("b")).first()
    # a few rows per year
    hol = [(r["ds"], r["holiday"]) for r in S.fr_holidays(features.sparkSession, years["a"], years["b"] + 1).collect()]
    return forecast_series(daily, ["zone_sk"], "ds", "y", freq="D", horizon=horizon,
                           scales=[0.05, 0.1, 0.3], holdout="fifth", min_points=10, min_train=5,
                           yearly=10, weekly=3, holidays=hol, lower=0.0, upper=10.0)


def mob_stationarity(features: DataFrame) -> DataFrame:
    """Y8 + Y9: ADF and KPSS per zone on the daily congestion series."""
    return stationarity_tests(M.daily_congestion(features), ["zone_sk"], "ds", "y")


def mob_ar_boost(features: DataFrame, max_iter: int = 100) -> DataFrame:
    """Y10 + W3 + W8 + M1/M4 + Y12: boosted autoregression on lag features,
    evaluated on each zone's tail holdout."""
    d = M.series_features(M.daily_congestion(features))
    d = SP.tail_holdout(d, ["zone_sk"], ["ds"], horizon=30).dropna(subset=["lag_1", "lag_7"])
    d = d.withColumn("dow", F.dayofweek("ds")).withColumn("zone", F.col("zone_sk").cast("double"))
    cols = ["lag_1", "lag_7", "lag_14", "rolling_7_mean", "dow", "zone"]
    d = stage(d, "ar-boost")
    train, test = d.where(F.col("is_holdout") == 0), d.where(F.col("is_holdout") == 1)
    model, = B.boost(train, [B.Fit("y", tuple(cols), F.lit(True), rounds=max_iter, depth=3)], F.xxhash64("zone_sk", "ds"))
    p = model.transform(test)
    m = MT.regression_metrics(p, "y", "prediction")
    mp = MT.mape(p, "y", "prediction").select("mape").scalar()
    return m.select(F.lit("ar_boost").alias("model"), "n", "mae", "rmse", mp.alias("mape"))


# -- safety -------------------------------------------------------------------

def _severity_rows(features: DataFrame) -> DataFrame:
    df = SP.stratified_kfold(features, "severity_class", "fact_impact_sk", 5)
    return stage(SV.balanced_weights(df, "severity_class"), "severity")


def safe_severity_forest(features: DataFrame, n_trees: int = 300, n_final: int = 500,
                         leaky: bool = False) -> DataFrame:
    """L9 + X5 + X6 + M6 + G16 + L16: class-balanced random forest; shuffled
    stratified 5-fold out-of-fold predictions, per-fold macro F1 (mean, std),
    out-of-fold report, top importances of the final model."""
    cols = SAFE_FEATURES + (SAFE_LEAKY if leaky else [])
    df = _severity_rows(features)

    def fold(k: int):
        if k < 0:
            return fit(SV.random_forest("severity_class", "w", n_final), df, cols)
        model = fit(SV.random_forest("severity_class", "w", n_trees), df.where(F.col("fold") != k), cols)
        return model.transform(df.where(F.col("fold") == k)).select(
            "fold", "severity_class", F.col("prediction").cast("int").alias("pred"))

    final, *parts = _concurrently(fold, [-1, *range(5)])
    oof = stage(_union(parts), "out-of-fold")
    stats = MT.mean_std(fold_f1(oof), "f1_macro")
    summary = MT.f1_summary(oof, "severity_class", "pred")
    top = importances(final, cols, 3).agg(F.concat_ws(",", F.collect_list("feature")).alias("top_features"))
    return MT.one_row(summary, stats.select(F.col("mean").alias("cv_f1_macro_mean"),
                                            F.col("std").alias("cv_f1_macro_std")), top)


def fold_f1(oof: DataFrame) -> DataFrame:
    """Macro F1 per fold, from counts per (fold, class)."""
    seen = oof.select("fold", F.explode(F.array(
        F.struct(F.col("severity_class").alias("c"), F.lit(1).alias("truth"), F.lit(0).alias("said")),
        F.struct(F.col("pred").alias("c"), F.lit(0).alias("truth"), F.lit(1).alias("said")))).alias("x"),
        (F.col("severity_class") == F.col("pred")).cast("int").alias("hit"))
    per = seen.groupBy("fold", "x.c").agg(F.sum("x.truth").alias("t"), F.sum("x.said").alias("s"),
                                          F.sum(F.col("hit") * F.col("x.truth")).alias("tp"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("t") + F.col("s")), F.lit(0.0))
    return per.groupBy("fold").agg(F.avg(f1).alias("f1_macro"))


def safe_severity_predictions(features: DataFrame, n_final: int = 500) -> DataFrame:
    """L14 + IO7 + BI5: predicted severity and class probability of every row."""
    df = _severity_rows(features)
    model = fit(SV.random_forest("severity_class", "w", n_final), df, SAFE_FEATURES)
    return positive_probability(model.transform(df)).select(
        "fact_impact_sk", "time_sk", "zone_sk", "mode_sk", "annee", "mois", "severity_class",
        F.col("prediction").cast("int").alias("severity_predicted"), F.col("proba").alias("severity_proba"))


def safe_importances(features: DataFrame, n_final: int = 500) -> DataFrame:
    """L16 + T5: Gini importance of every feature of the severity forest."""
    df = _severity_rows(features)
    return importances(fit(SV.random_forest("severity_class", "w", n_final), df, SAFE_FEATURES), SAFE_FEATURES)


def safe_forest_grid(features: DataFrame) -> DataFrame:
    """Severity forests over the reference's 6-point grid, macro F1 on the
    stratified folds; MLlib's depth limit of 30 stands for unlimited."""
    est = SV.random_forest("severity_class", "w")
    points = [(n, d) for n in (100, 200) for d in (5, 10, 30)]  # Fixed values: the grid.
    grid = [{est.numTrees: n, est.maxDepth: d} for n, d in points]
    df = _severity_rows(features)
    avg, std = SV.cross_validate_fixed_folds(est, df, SAFE_FEATURES, "severity_class", "fold", grid, "f1_macro")
    return SV.grid_table(df.sparkSession, ["n_trees", "max_depth"], points, avg, std, larger_is_better=True)


def safe_rff_svm(features: DataFrame) -> DataFrame:
    """L13 + X6: approximate RBF SVM (random Fourier features + linear SVM,
    balanced weights, Platt probabilities); every row is scored by the model of
    the four folds that it is not in."""
    df = features.withColumn("label", (F.col("severity_class") > 0).cast("double"))
    df = SP.stratified_kfold(df, "label", "fact_impact_sk", 5)
    df = pop_standardize(df, SAFE_FEATURES, suffix="_z")
    zcols = [f"{c}_z" for c in SAFE_FEATURES]
    df = stage(SV.balanced_weights(df, "label").select("label", "w", "fold", *zcols), "svm")

    def fold(k: int):
        model = RFFSVM(zcols, "label", "w").fit(df.where(F.col("fold") != k))
        return model.transform(df.where(F.col("fold") == k)).select("label", "proba", "svm_pred")

    scored = stage(_union(_concurrently(fold, list(range(5)), 5)), "svm-scored")
    auc = CU.roc_auc(scored, "label", "proba").select("auc").scalar()
    sc = MT.binary_scores(scored.withColumn("y_pred", F.col("svm_pred").cast("int")), "label", "y_pred")
    return sc.select(auc.alias("auc"), "precision", "recall", "f1", "accuracy", "n")


def safe_zone_clusters(features: DataFrame, k: int = 3, n_init: int = 20) -> DataFrame:
    """L4 + W7 + E1 + M9/M10/M11: zone risk profile, population-std scaled,
    K-Means k=3 with restarts, clusters ranked Low/Medium/High by the mean of
    their raw feature means (the reference's behaviour, quirk Q5)."""
    prof = SF.zone_risk_profile(features)
    scaled = materialize(pop_standardize(prof, SAFE_CLUSTER))
    cols = [f"{c}_scaled" for c in SAFE_CLUSTER]
    _, assigned, cost = CL.kmeans_restarts(scaled, cols, k, n_init)
    labelled = CL.rank_labels(assigned, SAFE_CLUSTER)
    q = CL.cluster_quality(assigned, cols).first()
    return (labelled.select("zone_sk", F.col("cluster_id").alias("risk_cluster_id"), "risk_level",
                            "zone_nom", "zone_code", "ville", *SAFE_CLUSTER)
                    .withColumn("silhouette", F.lit(q["silhouette"]))
                    .withColumn("inertia", F.lit(q["inertia"]))
                    .withColumn("davies_bouldin", F.lit(q["davies_bouldin"])))


def safe_ward(features: DataFrame, k: int = 3) -> DataFrame:
    """Ward clusters of the scaled zone risk profile; ``merge_height`` is the
    height at which a zone's cluster meets another one."""
    prof = materialize(pop_standardize(SF.zone_risk_profile(features), SAFE_CLUSTER))
    out, merges = ward(prof, [f"{c}_scaled" for c in SAFE_CLUSTER], k)
    last = merges.orderBy(F.desc("step")).limit(max(k - 1, 1)).agg(F.min("height").alias("h"))
    return out.select("zone_sk", "ward_cluster", last.select("h").scalar().alias("merge_height"))


def safe_ward_merges(features: DataFrame) -> DataFrame:
    """The merge table of the zone risk profile's Ward hierarchy."""
    prof = materialize(pop_standardize(SF.zone_risk_profile(features), SAFE_CLUSTER))
    return ward(prof, [f"{c}_scaled" for c in SAFE_CLUSTER])[1]


def safe_anomalies(features: DataFrame, n_trees: int = 300) -> DataFrame:
    """L10 + E1 + P10: isolation forest over the scaled anomaly features of
    every row, sklearn sign conventions, 5 % contamination."""
    a = features.dropna(subset=SF.ANOMALY_FEATURES + ["time_sk", "annee"])
    z = pop_standardize(a, SF.ANOMALY_FEATURES, suffix="_z")
    out = ISO.detect(z, [f"{c}_z" for c in SF.ANOMALY_FEATURES], "fact_impact_sk",
                     contamination=0.05, n_trees=n_trees)
    return materialize(out.select("zone_sk", "time_sk", "annee", "mois", "anomaly_score",
                                  "is_anomaly", "anomaly_label", *TERRITORIAL_ORDER))


def safe_anomaly_alerts(features: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` strongest alerts."""
    an = safe_anomalies(features)
    return an.where(F.col("is_anomaly") == 1).orderBy("anomaly_score", *TERRITORIAL_ORDER).limit(n)


def safe_anomaly_report(features: DataFrame) -> DataFrame:
    """G17 + G12 + T3 + M12: anomaly count/rate, precision@k of the
    heuristic, alerts of the worst zone, the 10 strongest alerts."""
    an = safe_anomalies(features)
    rate = an.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_anomaly").alias("n_anomalies"))
    prec = SF.precision_at_k(an, "anomaly_score", TERRITORIAL_ORDER)
    top10 = (an.where(F.col("is_anomaly") == 1).orderBy("anomaly_score", *TERRITORIAL_ORDER).limit(10)
               .agg(F.count(F.lit(1)).alias("n_top"), F.min("anomaly_score").alias("min_score")))
    per_zone = an.groupBy("zone_sk").agg(F.sum("is_anomaly").alias("a")).agg(
        F.max("a").alias("max_alerts_in_a_zone"))
    return MT.one_row(rate.withColumn("anomaly_rate_pct", F.col("n_anomalies") / F.col("n_rows") * 100),
                      prec, top10, per_zone)
