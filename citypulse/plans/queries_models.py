"""Registered model queries. Model fits, randomised and iterative
algorithms have no SQL oracle; ``tests/test_model_properties.py`` checks the
models by properties, ``queries_checked`` what follows them against SQL."""

from __future__ import annotations

from citypulse.plans import ecology as E
from citypulse.plans import mobility as M
from citypulse.plans import safety as SF
from citypulse.plans import training as TR
from citypulse.plans.catalog import register


def _eco(w):
    return E.engineer_features(E.clean_territorial(w))


def _mob(w):
    return M.engineer_features(M.clean_mobility(w))


def _safe(w):
    return SF.severity_features(SF.clean_safety(w))


@register("eco_co2_regression", "L1 L2 X1 E2 M1 M2 L14",
          "model:s n:i rmse:f mae:f r2:f n_train:i status:s")
def eco_co2_regression(w):
    """Boosted log-CO2 regression: combined model and one model per mode,
    temporal split, test metrics on kg."""
    return TR.eco_co2_regression(_eco(w))


@register("eco_lasso_grid", "L11 X7 X4 M3", "alpha:f cv_rmse_mean:f cv_rmse_std:f")
def eco_lasso_grid(w):
    """Lasso alpha grid with contiguous 5-fold CV (mean/std RMSE)."""
    return TR.eco_lasso_grid(_eco(w))


@register("eco_pollution_clusters", "L4 L8 E1 J3 M9 M10 M11",
          "zone_sk:i zone_nom:s cluster_id:i cluster_label:s pm25_scaled:f no2_scaled:f "
          "co2_kg_scaled:f energie_kwh_scaled:f k:i silhouette:f inertia:f davies_bouldin:f")
def eco_pollution_clusters(w):
    """Zone pollution clusters (k by silhouette) named by centroid rules."""
    return TR.eco_pollution_clusters(_eco(w))


@register("eco_elbow", "L4 M9 M10", "k:i silhouette:f inertia:f status:s")
def eco_elbow(w):
    """Elbow table of the zone pollution profile, k = 2 to 8."""
    return TR.eco_elbow(_eco(w))


@register("eco_pca_profile", "L7 E1", "zone_sk:i pc1:f pc2:f")
def eco_pca_profile(w):
    """Two principal components of the standardised zone profile."""
    return TR.eco_pca(_eco(w))


@register("eco_forecasts", "Y1 Y3 Y4 Y5 J6 P15 F3",
          "zone_sk:i ds:d row_type:s aqi_forecast:f aqi_lower:f aqi_upper:f pm25_forecast:f "
          "pm25_lower:f pm25_upper:f co2_forecast:f co2_lower:f co2_upper:f nrj_forecast:f "
          "nrj_lower:f nrj_upper:f")
def eco_forecasts(w):
    """Monthly AQI / PM2.5 / CO2 / energy forecasts per zone, 24 months ahead."""
    return TR.eco_forecasts(E.clean_territorial(w))


@register("eco_forecast_summary", "Y6 G16 Y12",
          "target:s holdout_mae_mean:f insample_mae_mean:f n_series:i")
def eco_forecast_summary(w):
    """Mean forecast MAE per target (honest holdout and in-sample last 3)."""
    return TR.eco_forecast_summary(E.clean_territorial(w))


@register("eco_sarima", "Y7", "zone_sk:i step:i forecast:f holdout_mae:f holdout_mape:f ar:f ma:f seasonal_ar:f status:s")
def eco_sarima(w):
    """Seasonal AR(1)(1)12 + MA(1) forecasts of monthly AQI, 3 steps."""
    return TR.eco_sarima(E.clean_territorial(w))


@register("eco_future_predictions", "L15 L14 J7 W5 F9",
          "zone_sk:i mode_sk:i annee:i mois:i annee_mois_dt:d co2_predicted:f "
          "energie_predicted:f carbon_intensity:f prediction_type:s")
def eco_future_predictions(w):
    """CO2 / energy predictions over the 24-month scenario grid."""
    return TR.eco_future_predictions(_eco(w))


@register("mob_load_regression", "L1 X2 X4 M3 E2 M1",
          "n:i rmse:f mae:f r2:f cv_rmse_mean:f cv_rmse_std:f rounds:i max_depth:i")
def mob_load_regression(w):
    """Boosted passenger-load regression with train-only encodings."""
    return TR.mob_load_regression(_mob(w))


@register("mob_cancellation_classifier", "L3 X3 M5 M7 M8 W10 W11 M16 P18 L14",
          "auc:f tp:i fp:i fn:i n:i precision:f recall:f f1:f best_threshold:f best_f1:f "
          "n_low:i n_medium:i n_high:i")
def mob_cancellation_classifier(w):
    """Weighted boosted cancellation classifier: AUC, confusion at 0.5,
    best-F1 threshold, risk bands."""
    return TR.mob_cancellation(_mob(w))


@register("mob_logistic_baseline", "L12 M7", "auc:f n_pos:i n_neg:i")
def mob_logistic_baseline(w):
    """Balanced logistic regression baseline (AUC)."""
    return TR.mob_logistic(_mob(w))


@register("mob_congestion_forecast", "Y2 Y3 Y6 F13 P15 W8",
          "zone_sk:i ds:d yhat:f yhat_lower:f yhat_upper:f row_type:s best_scale:f holdout_mae:f "
          "holdout_mape:f n_points:i status:s")
def mob_congestion_forecast(w):
    """Daily congestion forecast per zone, 30 days, clamped to [0, 10]."""
    return TR.mob_congestion_forecast(_mob(w))


@register("mob_stationarity", "Y8 Y9",
          "zone_sk:i n:i adf_stat:f adf_lag:i adf_crit_5:f adf_stationary:i kpss_stat:f "
          "kpss_lag:i kpss_stationary:i status:s")
def mob_stationarity(w):
    """ADF and KPSS statistics of each zone's daily congestion."""
    return TR.mob_stationarity(_mob(w))


@register("mob_ar_boost", "Y10 W3 Y12 M4", "model:s n:i mae:f rmse:f mape:f")
def mob_ar_boost(w):
    """Boosted autoregressive congestion model on the tail holdout."""
    return TR.mob_ar_boost(_mob(w))


@register("safe_severity_forest", "L9 X5 X6 M6 G16 L16 T5",
          "accuracy:f f1_macro:f f1_weighted:f n:i cv_f1_macro_mean:f cv_f1_macro_std:f "
          "top_features:s")
def safe_severity_forest(w):
    """Balanced random forest, stratified 5-fold out-of-fold report."""
    return TR.safe_severity_forest(_safe(w))


@register("eco_forecast_comparison", "M14 Y12 Y6", "model:s mae:f mape:f n_series:i")
def eco_forecast_comparison(w):
    """Forecast models compared by MAE and MAPE on the last three months."""
    return TR.eco_forecast_comparison(E.clean_territorial(w))


@register("safe_rff_svm", "L13 X6", "auc:f precision:f recall:f f1:f accuracy:f n:i")
def safe_rff_svm(w):
    """Approximate RBF SVM (random Fourier features) for serious accidents, out of fold."""
    return TR.safe_rff_svm(_safe(w))


@register("safe_zone_clusters", "L4 W7 E1 M9 M10 M11 G13",
          "zone_sk:i risk_cluster_id:i risk_level:s zone_nom:s zone_code:s ville:s "
          "nb_accidents:f nb_graves:f volume_crimes:f taux_criminalite:f usagers_vulnerables:f "
          "silhouette:f inertia:f davies_bouldin:f")
def safe_zone_clusters(w):
    """Zone risk clusters (k=3, restarts) ranked Low / Medium / High."""
    return TR.safe_zone_clusters(_safe(w))


@register("safe_ward_clusters", "L6", "zone_sk:i ward_cluster:i merge_height:f")
def safe_ward_clusters(w):
    """Ward clusters of the zone risk profile (3 clusters)."""
    return TR.safe_ward(_safe(w))


@register("safe_ward_merges", "L6", "step:i left:i right:i height:f size:i")
def safe_ward_merges(w):
    """Merge table of the Ward hierarchy over the zone risk profile."""
    return TR.safe_ward_merges(_safe(w))


@register("safe_isolation_forest", "L10 E1",
          "zone_sk:i time_sk:i annee:i mois:i anomaly_score:f is_anomaly:i anomaly_label:s")
def safe_isolation_forest(w):
    """Isolation-forest anomaly flags of every safety row (5 % contamination)."""
    return TR.safe_anomalies(_safe(w))


@register("safe_anomaly_report", "G17 G12 T3 M12 T2",
          "n_rows:i n_anomalies:i anomaly_rate_pct:f k:i n_expected:i precision_at_k:f n_top:i "
          "min_score:f max_alerts_in_a_zone:i")
def safe_anomaly_report(w):
    """Anomaly rate, precision@k heuristic, top-10 alerts, alerts per zone."""
    return TR.safe_anomaly_report(_safe(w))


@register("eco_dbscan_profile", "L5 J9 E1", "zone_sk:i dbscan_label:i")
def eco_dbscan_profile(w):
    """DBSCAN (eps 1.5, min 2) of the standardised zone pollution profile."""
    from citypulse.operators.models.dbscan import dbscan
    return dbscan(E.zone_pollution_profile(_eco(w)), [f"{c}_scaled" for c in E.PROFILE_FEATURES], "zone_sk")


@register("mob_model_comparison", "M14 Y12", "model:s auc:f")
def mob_model_comparison(w):
    """Model comparison table for the cancellation task: boosted trees vs
    balanced logistic regression, AUC on the same stratified test split."""
    from pyspark.sql import functions as F
    f = _mob(w)
    gbt = TR.mob_cancellation(f).select(F.lit("boosted_trees").alias("model"), "auc")
    lr = TR.mob_logistic(f).select(F.lit("logistic_regression").alias("model"), "auc")
    return gbt.unionByName(lr)


@register("eco_co2_predictions", "L14 IO7 BI5 M13",
          "model:s fact_impact_sk:i zone_sk:i mode_sk:i time_sk:i annee_mois_dt:d co2_kg:f co2_pred:f residual:f")
def eco_co2_predictions(w):
    """Actual and predicted CO2 of every test row, combined and per mode."""
    return TR.eco_co2_predictions(_eco(w))


@register("eco_tree_grid", "X7 T6", "n_rounds:f max_depth:f step:f cv_mean:f cv_std:f best:i")
def eco_tree_grid(w):
    """Eight-point grid search of the boosted CO2 regression."""
    return TR.eco_tree_grid(_eco(w))


@register("mob_load_predictions", "L14 IO7 BI5",
          "fact_mob_sk:i time_sk:i zone_sk:i line_sk:i mode_sk:i charge_estimee:f charge_predicted:f is_test:i")
def mob_load_predictions(w):
    """Predicted load of every trip."""
    return TR.mob_load_predictions(_mob(w))


@register("mob_cancellation_predictions", "L14 IO7 BI5 P18",
          "fact_mob_sk:i time_sk:i zone_sk:i line_sk:i mode_sk:i retard_flag:i proba:f risk_label:s is_test:i")
def mob_cancellation_predictions(w):
    """Cancellation probability and risk band of every trip."""
    return TR.mob_cancellation_predictions(_mob(w))


@register("mob_tree_grid", "X7 T6", "n_rounds:f max_depth:f cv_mean:f cv_std:f best:i")
def mob_tree_grid(w):
    """Four-point grid search of the boosted load regression."""
    return TR.mob_tree_grid(_mob(w))


@register("safe_severity_predictions", "L14 IO7 BI5",
          "fact_impact_sk:i time_sk:i zone_sk:i mode_sk:i annee:i mois:i severity_class:i "
          "severity_predicted:i severity_proba:f")
def safe_severity_predictions(w):
    """Predicted severity of every safety row."""
    return TR.safe_severity_predictions(_safe(w))


@register("safe_importances", "L16 T5", "feature:s importance:f")
def safe_importances(w):
    """Feature importances of the severity forest, with values."""
    return TR.safe_importances(_safe(w))


@register("safe_forest_grid", "X7 T6", "n_trees:f max_depth:f cv_mean:f cv_std:f best:i")
def safe_forest_grid(w):
    """Six-point grid search of the severity forest."""
    return TR.safe_forest_grid(_safe(w))


@register("safe_anomaly_alerts", "T3", "zone_sk:i time_sk:i annee:i mois:i anomaly_score:f anomaly_label:s")
def safe_anomaly_alerts(w):
    """The ten strongest anomaly alerts."""
    return TR.safe_anomaly_alerts(_safe(w))
