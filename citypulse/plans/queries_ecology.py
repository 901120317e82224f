"""Registered ecology queries (Spark plan + DuckDB oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.plans import ecology as E
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views

CLEAN_SPEC = ("fact_impact_sk:i time_sk:i zone_sk:i mode_sk:i energie_kwh:f co2_kg:f aqi_index:f "
              "pm25:f no2:f nb_accidents:i nb_graves:i nb_mortels:i usagers_vulnerables:i "
              "volume_crimes:i taux_criminalite:f annee:i mois:i zone_nom:s zone_code:s ville:s")


@register("eco_clean_facts", "IO1 IO2 IO3 J1 J2 P1 P3 P4 P5 P6 P7 P8", CLEAN_SPEC,
          with_views("SELECT * FROM eco_clean", "eco_clean"))
def eco_clean_facts(w):
    """Territorial facts: time join, keep-first dedup on (time, zone, mode),
    zone join, phantom-zone filter, keep-list, ``co2_kg > 0``."""
    return E.clean_territorial(w)


CI_SQL = with_views("""
SELECT zone_sk, min(zone_nom) AS zone_nom, count(*) AS n_rows,
       avg(carbon_intensity) AS carbon_intensity_mean,
       median(carbon_intensity) AS carbon_intensity_median,
       quantile_cont(carbon_intensity, 0.9) AS carbon_intensity_p90,
       sum(co2_nz) AS co2_total_kg, sum(energie_nz) AS energie_total_kwh
FROM eco_ci GROUP BY zone_sk""", "eco_ci")


@register("carbon_intensity_by_zone", "G1 G8 P9 P20 F11",
          "zone_sk:i zone_nom:s n_rows:i carbon_intensity_mean:f carbon_intensity_median:f "
          "carbon_intensity_p90:f co2_total_kg:f energie_total_kwh:f", CI_SQL)
def carbon_intensity_by_zone(w):
    """Flagship KPI: carbon intensity (kg CO2 per kWh) mean / median / p90 and
    CO2 / energy totals per zone, exact quantiles."""
    return E.carbon_kpi_by_zone(E.clean_territorial(w))


@register("kpi_carbon_summary", "G8",
          "carbon_intensity_mean:f carbon_intensity_median:f carbon_intensity_p90:f "
          "co2_total_kg:f energie_total_kwh:f",
          with_views("""
SELECT avg(carbon_intensity) AS carbon_intensity_mean,
       median(carbon_intensity) AS carbon_intensity_median,
       quantile_cont(carbon_intensity, 0.9) AS carbon_intensity_p90,
       sum(co2_nz) AS co2_total_kg, sum(energie_nz) AS energie_total_kwh
FROM eco_ci""", "eco_ci"))
def kpi_carbon_summary(w):
    """Global carbon KPI block of the evaluation report."""
    return E.carbon_kpi(E.clean_territorial(w))


FEAT_SPEC = ("fact_impact_sk:i zone_sk:i mode_sk:i annee_mois_dt:d zone_encoded:i mode_encoded:i "
             "mode_co2_mean:f mois_sin:f mois_cos:f co2_log:f energie_log:f co2_lag1:f "
             "energie_lag1:f aqi_lag1:f pm25_lag1:f co2_lag3:f energie_lag3:f aqi_lag3:f "
             "pm25_lag3:f co2_roll3:f energie_roll3:f pm25_roll3:f carbon_intensity:f")


@register("eco_regression_features", "F1 F8 F9 P9 P10 W1 W2 W6 G6 P20 T1", FEAT_SPEC,
          with_views("SELECT * FROM eco_features", "eco_features"))
def eco_regression_features(w):
    """Regression feature table: month date, zero->missing targets, dense
    zone/mode codes, mode CO2 mean, cyclical month, log targets, lags 1/3
    and previous-3 rolling means per (zone, mode), carbon intensity."""
    return E.engineer_features(E.clean_territorial(w))


@register("eco_zone_profile", "G1 J3 E1 P9 P10",
          "zone_sk:i zone_nom:s pm25:f no2:f co2_kg:f energie_kwh:f pm25_scaled:f no2_scaled:f "
          "co2_kg_scaled:f energie_kwh_scaled:f",
          with_views("""
WITH p AS (SELECT zone_sk, avg(pm25) AS pm25, avg(no2) AS no2, avg(co2_kg) AS co2_kg,
                  avg(energie_kwh) AS energie_kwh
           FROM eco_features WHERE pm25 IS NOT NULL AND no2 IS NOT NULL
             AND nullif(co2_kg, 0) IS NOT NULL AND nullif(energie_kwh, 0) IS NOT NULL
           GROUP BY zone_sk),
n AS (SELECT zone_sk, min(zone_nom) AS zone_nom FROM eco_features GROUP BY zone_sk),
s AS (SELECT avg(pm25) m1, stddev_pop(pm25) s1, avg(no2) m2, stddev_pop(no2) s2,
             avg(co2_kg) m3, stddev_pop(co2_kg) s3, avg(energie_kwh) m4, stddev_pop(energie_kwh) s4
      FROM p)
SELECT p.zone_sk, coalesce(n.zone_nom, 'Zone_' || CAST(p.zone_sk AS VARCHAR)) AS zone_nom,
       pm25, no2, co2_kg, energie_kwh,
       CASE WHEN s1 > 0 THEN (pm25 - m1) / s1 ELSE 0 END AS pm25_scaled,
       CASE WHEN s2 > 0 THEN (no2 - m2) / s2 ELSE 0 END AS no2_scaled,
       CASE WHEN s3 > 0 THEN (co2_kg - m3) / s3 ELSE 0 END AS co2_kg_scaled,
       CASE WHEN s4 > 0 THEN (energie_kwh - m4) / s4 ELSE 0 END AS energie_kwh_scaled
FROM p LEFT JOIN n USING (zone_sk), s""", "eco_features"))
def eco_zone_profile(w):
    """Pollution clustering input: zone means of pm25/no2/co2/energy on the
    feature rows, zone names (else ``Zone_<sk>``), population z-scores."""
    return E.zone_pollution_profile(E.engineer_features(E.clean_territorial(w)))


@register("eco_zone_month_targets", "G3 F1 P9",
          "zone_sk:i annee_mois_dt:d aqi_index:f pm25:f co2_kg:f energie_kwh:f",
          with_views("""
SELECT zone_sk, make_date(annee, mois, 1) AS annee_mois_dt, avg(nullif(aqi_index, 0)) AS aqi_index,
       avg(pm25) AS pm25, avg(nullif(co2_kg, 0)) AS co2_kg, avg(nullif(energie_kwh, 0)) AS energie_kwh
FROM eco_clean GROUP BY zone_sk, make_date(annee, mois, 1)""", "eco_clean"))
def eco_zone_month_targets(w):
    """Forecast input: zone x month means of AQI, PM2.5, CO2 and energy."""
    return E.zone_month_targets(E.clean_territorial(w))


@register("eco_temporal_split", "X1 G15 F2",
          "is_test:i n_rows:i first_month:d last_month:d",
          with_views("""
WITH c AS (SELECT max(annee_mois_dt) - INTERVAL 8 MONTH AS cutoff FROM eco_features)
SELECT CASE WHEN annee_mois_dt > cutoff THEN 1 ELSE 0 END AS is_test, count(*) AS n_rows,
       min(annee_mois_dt) AS first_month, max(annee_mois_dt) AS last_month
FROM eco_features, c GROUP BY 1""", "eco_features"))
def eco_temporal_split(w):
    """Temporal train/test split: the last 8 months are the test side."""
    f = E.temporal_split(E.engineer_features(E.clean_territorial(w)))
    return f.groupBy("is_test").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.min("annee_mois_dt").alias("first_month"),
                                    F.max("annee_mois_dt").alias("last_month"))


FUT_MED = ", ".join(f"median({c}) AS {c}" for c in E.FUTURE_MEDIAN_COLS)


@register("eco_future_grid", "J7 W5 F3 F5 F8 G15",
          "zone_sk:i mode_sk:i annee:i mois:i annee_mois_dt:d mois_sin:f " +
          " ".join(f"{c}:f" for c in E.FUTURE_MEDIAN_COLS),
          with_views(f"""
WITH ly AS (SELECT max(annee) AS y FROM eco_features),
lm AS (SELECT max(mois) AS m FROM eco_features, ly WHERE annee = ly.y),
st AS (SELECT make_date(ly.y, lm.m, 1) AS s FROM ly, lm),
combos AS (SELECT DISTINCT zone_sk, mode_sk FROM eco_features),
recent AS (SELECT * FROM eco_features QUALIFY row_number() OVER (
    PARTITION BY zone_sk, mode_sk ORDER BY annee_mois_dt DESC, time_sk DESC,
    fact_impact_sk DESC) <= 12),
med AS (SELECT zone_sk, mode_sk, {FUT_MED} FROM recent GROUP BY zone_sk, mode_sk),
months AS (SELECT CAST(s + to_months(CAST(i AS INTEGER)) AS DATE) AS annee_mois_dt
           FROM st, range(1, 25) r(i))
SELECT c.zone_sk, c.mode_sk, year(annee_mois_dt) AS annee, month(annee_mois_dt) AS mois,
       annee_mois_dt, sin(2 * pi() * month(annee_mois_dt) / 12.0) AS mois_sin, med.* EXCLUDE (zone_sk, mode_sk)
FROM combos c CROSS JOIN months JOIN med USING (zone_sk, mode_sk)""", "eco_features"))
def eco_future_grid(w):
    """Future scenario grid: (zone, mode) x next 24 months with the medians
    of each series' last 12 rows as scenario features."""
    return E.future_grid(E.engineer_features(E.clean_territorial(w)))


@register("eco_forecast_eligibility", "Y4 G3 P10",
          "zone_sk:i target:s n_points:i eligible:i",
          with_views("""
WITH m AS (SELECT zone_sk, make_date(annee, mois, 1) AS ds, avg(nullif(aqi_index, 0)) AS aqi_index,
                  avg(pm25) AS pm25, avg(nullif(co2_kg, 0)) AS co2_kg,
                  avg(nullif(energie_kwh, 0)) AS energie_kwh
           FROM eco_clean GROUP BY zone_sk, ds),
l AS (SELECT zone_sk, 'aqi_index' AS target, count(aqi_index) AS n FROM m GROUP BY zone_sk
      UNION ALL SELECT zone_sk, 'pm25', count(pm25) FROM m GROUP BY zone_sk
      UNION ALL SELECT zone_sk, 'co2_kg', count(co2_kg) FROM m GROUP BY zone_sk
      UNION ALL SELECT zone_sk, 'energie_kwh', count(energie_kwh) FROM m GROUP BY zone_sk)
SELECT zone_sk, target, n AS n_points, CASE WHEN n >= 18 THEN 1 ELSE 0 END AS eligible
FROM l WHERE n > 0""", "eco_clean"))
def eco_forecast_eligibility(w):
    """Which (zone, target) monthly series are long enough (>= 18 points)."""
    m = E.zone_month_targets(E.clean_territorial(w))
    parts = [E.series_eligibility(m, t) for t in ["aqi_index", "pm25", "co2_kg", "energie_kwh"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
