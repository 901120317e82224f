"""Registered mobility queries (Spark plan + DuckDB oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.operators.splits import hash_unit_sql, tail_holdout
from citypulse.plans import mobility as M
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views


def _features(w):
    return M.engineer_features(M.clean_mobility(w))


@register("mob_clean_facts", "IO1 IO2 J1 P1 P3 P4 P7 P9",
          "fact_mob_sk:i time_sk:i zone_sk:i line_sk:i mode_sk:i stop_sk:i annule:i "
          "charge_estimee:f vitesse_kmh:f temps_trajet_min:f congestion_index:f stress_1_5:f "
          "satisfaction_1_5:f annee:i mois:i heure:s jour_semaine:s periode:s weekend:s",
          with_views("SELECT * FROM mob_clean", "mob_clean"))
def mob_clean_facts(w):
    """Service facts joined to the hourly time dimension, keep-list, numeric
    coercion, zero speed -> missing."""
    return M.clean_mobility(w)


@register("mob_trip_features", "P12 F6 F7 W6 P23",
          "fact_mob_sk:i zone_sk:i vitesse_kmh:f temps_trajet_min:f stress_1_5:f hour:i "
          "rush_hour:i is_weekend:i zone_encoded:i line_encoded:i mode_encoded:i retard_flag:i",
          with_views("SELECT * FROM mob_features", "mob_features"))
def mob_trip_features(w):
    """Zone-median imputation with global fallback, hour from HH:MM:SS,
    rush-hour and weekend flags, dense codes, cancellation label."""
    return _features(w)


@register("kpi_punctuality", "G7",
          "n_trips:i n_cancelled:i punctuality_pct:f",
          with_views("""
SELECT count(*) AS n_trips, sum(annule) AS n_cancelled,
       (1 - sum(annule) / count(*)) * 100 AS punctuality_pct FROM mob_clean""", "mob_clean"))
def kpi_punctuality(w):
    """Punctuality KPI: share of trips not cancelled, in percent."""
    return M.punctuality(M.clean_mobility(w))


@register("mob_class_balance", "G10",
          "label:i n:i neg_pos_ratio:f",
          with_views("""
SELECT retard_flag AS label, count(*) AS n,
       (SELECT sum(CASE WHEN retard_flag = 0 THEN 1 ELSE 0 END) /
               nullif(sum(CASE WHEN retard_flag = 1 THEN 1 ELSE 0 END), 0) FROM mob_features)
         AS neg_pos_ratio
FROM mob_features GROUP BY retard_flag""", "mob_features"))
def mob_class_balance(w):
    """Cancellation class counts and the negative/positive ratio."""
    return M.class_balance(_features(w))


_SPLIT = hash_unit_sql("fact_mob_sk", 42)


@register("mob_load_encodings", "X2 E2 G5 J4 J5 P21",
          "fact_mob_sk:i is_test:i line_charge_mean:f zone_hour_charge:f hour_x_congestion:f "
          "weekend_x_zone:i",
          with_views(f"""
WITH s AS (SELECT *, CASE WHEN {_SPLIT} < 0.2 THEN 1 ELSE 0 END AS is_test FROM mob_features),
tr AS (SELECT * FROM s WHERE is_test = 0),
gm AS (SELECT avg(charge_estimee) AS g FROM tr),
lm AS (SELECT line_encoded, avg(charge_estimee) AS m FROM tr GROUP BY line_encoded),
zh AS (SELECT zone_encoded, hour, avg(charge_estimee) AS m FROM tr GROUP BY zone_encoded, hour)
SELECT s.fact_mob_sk, s.is_test, coalesce(lm.m, (SELECT g FROM gm)) AS line_charge_mean,
       coalesce(zh.m, (SELECT g FROM gm)) AS zone_hour_charge,
       s.hour * s.congestion_index AS hour_x_congestion, s.is_weekend * s.zone_encoded AS weekend_x_zone
FROM s LEFT JOIN lm USING (line_encoded) LEFT JOIN zh USING (zone_encoded, hour)""",
                     "mob_features"))
def mob_load_encodings(w):
    """Seeded id-hash 80/20 split; line and zone x hour mean load learnt on
    train rows, applied everywhere with the global mean as default;
    interaction features."""
    return M.load_encodings(_features(w))


@register("mob_daily_congestion", "W4 F1 F4 G4 T1",
          "zone_sk:i ds:d y:f",
          with_views("SELECT * FROM mob_daily", "mob_daily"))
def mob_daily_congestion(w):
    """Daily mean congestion per zone, days synthesised by cumcount % 28
    inside each (year, month, zone) ordered by hour."""
    return M.daily_congestion(_features(w))


@register("mob_series_features", "W3",
          "zone_sk:i ds:d y:f lag_1:f lag_7:f lag_14:f rolling_7_mean:f",
          with_views("""
SELECT zone_sk, ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7,
       lag(y, 14) OVER w AS lag_14,
       CASE WHEN count(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
            THEN avg(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS rolling_7_mean
FROM mob_daily WINDOW w AS (PARTITION BY zone_sk ORDER BY ds)""", "mob_daily"))
def mob_series_features(w):
    """Autoregressive features of the daily congestion series: lags 1/7/14
    and the mean of the previous 7 days (full windows only)."""
    return M.series_features(M.daily_congestion(_features(w)))


@register("mob_series_holdout", "W8 Y4",
          "zone_sk:i ds:d is_holdout:i",
          with_views("""
SELECT zone_sk, ds, CASE WHEN row_number() OVER (PARTITION BY zone_sk ORDER BY ds DESC)
       <= least(30, greatest(1, count(*) OVER (PARTITION BY zone_sk) // 5)) THEN 1 ELSE 0 END
       AS is_holdout FROM mob_daily""", "mob_daily"))
def mob_series_holdout(w):
    """Forecast holdout: the last min(30, max(1, n // 5)) days of each zone."""
    d = M.daily_congestion(_features(w))
    return tail_holdout(d, ["zone_sk"], ["ds"], horizon=30).select("zone_sk", "ds", "is_holdout")


@register("bi_mode_kpis", "BI3 G7 G14",
          "mode_sk:i n_trips:i punctuality_pct:f avg_speed_kmh:f avg_load:f avg_satisfaction:f "
          "corr_load_satisfaction:f",
          with_views("""
SELECT mode_sk, count(*) AS n_trips, (1 - avg(annule)) * 100 AS punctuality_pct,
       avg(vitesse_kmh) AS avg_speed_kmh, avg(charge_estimee) AS avg_load,
       avg(satisfaction_1_5) AS avg_satisfaction,
       corr(charge_estimee, satisfaction_1_5) AS corr_load_satisfaction
FROM mob_features GROUP BY mode_sk""", "mob_features"))
def bi_mode_kpis(w):
    """Executive KPI table by transport mode."""
    return M.mode_kpis(_features(w))


@register("bi_hotspots", "BI4 W13",
          "zone_sk:i hour:i n_trips:i avg_congestion:f n_cancelled:i congestion_rank:i",
          with_views("""
SELECT *, rank() OVER (PARTITION BY hour ORDER BY round(avg_congestion, 6) DESC) AS congestion_rank
FROM (SELECT zone_sk, hour, count(*) AS n_trips, avg(congestion_index) AS avg_congestion,
             sum(annule) AS n_cancelled FROM mob_features GROUP BY zone_sk, hour)""",
                     "mob_features"))
def bi_hotspots(w):
    """Congestion hotspots: zone x hour ranked within each hour."""
    return M.hotspots(_features(w))


@register("bi_bottom_lines", "T7 W13",
          "line_sk:i n_trips:i n_cancelled:i punctuality_pct:f rank:i",
          with_views("""
SELECT * FROM (SELECT *, rank() OVER (ORDER BY round(punctuality_pct, 6)) AS rank FROM (
  SELECT line_sk, count(*) AS n_trips, sum(annule) AS n_cancelled,
         (1 - sum(annule) / count(*)) * 100 AS punctuality_pct FROM mob_clean GROUP BY line_sk))
WHERE rank <= 10""", "mob_clean"))
def bi_bottom_lines(w):
    """The 10 least punctual lines (ties kept)."""
    return M.bottom_lines(M.clean_mobility(w), 10)
