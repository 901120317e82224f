"""Registered safety queries (Spark plan + DuckDB oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.plans import safety as SF
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views
from citypulse.sources.warehouse import TERRITORIAL_ORDER


def _features(w):
    return SF.severity_features(SF.clean_safety(w))


@register("safe_clean_facts", "P1 P2 P3 P5 P6 P7 P11 J1 J2 IO4",
          "fact_impact_sk:i time_sk:i zone_sk:i mode_sk:i nb_accidents:i nb_graves:i nb_mortels:i "
          "usagers_vulnerables:i volume_crimes:i taux_criminalite:f annee:i mois:i zone_nom:s "
          "zone_code:s ville:s",
          with_views("SELECT * FROM safe_clean", "safe_clean"))
def safe_clean_facts(w):
    """Safety facts: keep-first dedup, zone <= 10, drops, time and zone joins,
    keep-list, numeric coercion with zero fill."""
    return SF.clean_safety(w)


@register("safe_severity_features", "P17 P19 P20 W6 F11 F12",
          "fact_impact_sk:i zone_sk:i mode_sk:i time_sk:i severity_class:i severity_label:s "
          "gravite_index:f has_accident:i crime_rate_scaled:f zone_encoded:i mode_encoded:i",
          with_views("SELECT * FROM safe_features", "safe_features"))
def safe_severity_features(w):
    """Severity class (auto-binary under 40 fatal rows), labels, severity
    index, accident flag, crime-rate z-score, dense codes."""
    return _features(w)


@register("safe_severity_3class", "P17 P19 G10",
          "severity_class:i severity_label:s n:i",
          with_views("""
SELECT severity_class, severity_label, count(*) AS n FROM safe_raw_features
GROUP BY severity_class, severity_label""", "safe_raw_features"))
def safe_severity_3class(w):
    """The three-class severity branch (enough fatal rows) on the
    undeduplicated facts: class distribution."""
    return SF.class_distribution(SF.severity_features(SF.clean_safety(w, dedup=False)))


@register("safe_class_distribution", "G10",
          "severity_class:i severity_label:s n:i",
          with_views("""
SELECT severity_class, severity_label, count(*) AS n FROM safe_features
GROUP BY severity_class, severity_label""", "safe_features"))
def safe_class_distribution(w):
    """Severity class distribution of the deduplicated facts."""
    return SF.class_distribution(_features(w))


@register("safe_zone_risk_profile", "G2",
          "zone_sk:i nb_accidents:f nb_graves:f nb_mortels:f volume_crimes:f taux_criminalite:f "
          "usagers_vulnerables:f gravite_index:f zone_nom:s zone_code:s ville:s",
          with_views(f"""
SELECT zone_sk, avg(nb_accidents) AS nb_accidents, avg(nb_graves) AS nb_graves,
       avg(nb_mortels) AS nb_mortels, avg(volume_crimes) AS volume_crimes,
       avg(taux_criminalite) AS taux_criminalite, avg(usagers_vulnerables) AS usagers_vulnerables,
       avg(gravite_index) AS gravite_index,
       first(zone_nom ORDER BY {", ".join(TERRITORIAL_ORDER)}) FILTER (WHERE zone_nom IS NOT NULL) AS zone_nom,
       first(zone_code ORDER BY {", ".join(TERRITORIAL_ORDER)}) FILTER (WHERE zone_code IS NOT NULL) AS zone_code,
       first(ville ORDER BY {", ".join(TERRITORIAL_ORDER)}) FILTER (WHERE ville IS NOT NULL) AS ville
FROM safe_features GROUP BY zone_sk""", "safe_features"))
def safe_zone_risk_profile(w):
    """Zone risk profile: means of seven risk measures and the first name,
    code and city per zone (clustering input)."""
    return SF.zone_risk_profile(_features(w))


@register("kpi_safety", "G9 G11",
          "total_rows:i n_zones:i total_accidents:i total_graves:i total_mortels:i total_crimes:i "
          "densite_accidents:f indice_de_gravite:f",
          with_views("""
SELECT count(*) AS total_rows, count(DISTINCT zone_sk) AS n_zones,
       sum(nb_accidents) AS total_accidents, sum(nb_graves) AS total_graves,
       sum(nb_mortels) AS total_mortels, sum(volume_crimes) AS total_crimes,
       sum(nb_accidents) / count(DISTINCT zone_sk) AS densite_accidents,
       (sum(nb_graves) + sum(nb_mortels)) / greatest(sum(nb_accidents), 1) AS indice_de_gravite
FROM safe_features""", "safe_features"))
def kpi_safety(w):
    """Safety KPIs: accident density per zone, severity index, totals."""
    return SF.safety_kpis(_features(w))


_ORDER_SQL = ", ".join(TERRITORIAL_ORDER)


@register("safe_precision_at_k", "T2 M12 E1 P10",
          "k:i n_expected:i precision_at_k:f",
          with_views(f"""
WITH a AS (SELECT * FROM safe_features WHERE volume_crimes IS NOT NULL AND nb_accidents IS NOT NULL
             AND taux_criminalite IS NOT NULL AND zone_sk IS NOT NULL AND mois IS NOT NULL
             AND time_sk IS NOT NULL AND annee IS NOT NULL),
s AS (SELECT avg(volume_crimes) m1, stddev_pop(volume_crimes) s1, avg(nb_accidents) m2,
             stddev_pop(nb_accidents) s2, avg(taux_criminalite) m3, stddev_pop(taux_criminalite) s3,
             avg(zone_sk) m4, stddev_pop(zone_sk) s4, avg(mois) m5, stddev_pop(mois) s5,
             count(*) AS n FROM a),
z AS (SELECT a.*, -sqrt(
        pow(CASE WHEN s1 > 0 THEN (volume_crimes - m1) / s1 ELSE 0 END, 2) +
        pow(CASE WHEN s2 > 0 THEN (nb_accidents - m2) / s2 ELSE 0 END, 2) +
        pow(CASE WHEN s3 > 0 THEN (taux_criminalite - m3) / s3 ELSE 0 END, 2) +
        pow(CASE WHEN s4 > 0 THEN (zone_sk - m4) / s4 ELSE 0 END, 2) +
        pow(CASE WHEN s5 > 0 THEN (mois - m5) / s5 ELSE 0 END, 2)) AS anomaly_score,
        greatest(1, CAST(round_even(s.n * 0.05, 0) AS BIGINT)) AS k
      FROM a, s),
r AS (SELECT *, row_number() OVER (ORDER BY anomaly_score, {_ORDER_SQL}) AS rn FROM z)
SELECT max(k) AS k, sum(CASE WHEN mois IN (6, 7, 8) OR zone_sk IN (3, 6, 10) THEN 1 ELSE 0 END)
       AS n_expected,
       sum(CASE WHEN mois IN (6, 7, 8) OR zone_sk IN (3, 6, 10) THEN 1 ELSE 0 END) / max(k)
       AS precision_at_k
FROM r WHERE rn <= k""", "safe_features"))
def safe_precision_at_k(w):
    """Precision@k of a z-score distance anomaly score: share of the
    5 % lowest-scored rows that fall in summer months or zones 3/6/10."""
    f = _features(w)
    a = f.dropna(subset=SF.ANOMALY_FEATURES + ["time_sk", "annee"])
    scored = SF.zscore_outlier_score(a, SF.ANOMALY_FEATURES)
    return SF.precision_at_k(scored, "anomaly_score", TERRITORIAL_ORDER)
