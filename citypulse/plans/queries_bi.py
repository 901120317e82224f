"""Registered BI / data-quality / referential queries (with oracles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.operators import clean as C
from citypulse.operators.joins import orphans, semi
from citypulse.plans import bi as B
from citypulse.plans import ecology as E
from citypulse.plans import mobility as M
from citypulse.plans import safety as SF
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views

PROFILE_COLS = ["co2_kg", "energie_kwh", "aqi_index", "pm25", "no2"]


@register("quality_profile_territorial", "P24 P9",
          "column:s n_rows:i n_null:i n_zero:i min_value:f max_value:f mean_value:f median_value:f",
          with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
       sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS n_zero, min({c}) AS min_value,
       max({c}) AS max_value, avg({c}) AS mean_value, median({c}) AS median_value FROM territorial_dedup""" for c in PROFILE_COLS),
                     "territorial_dedup"))
def quality_profile_territorial(w):
    """Data-quality profile (nulls, zeros, min / max / mean) of the
    deduplicated territorial measures, one aggregate pass, unpivoted."""
    from citypulse.operators.dedup import keep_first
    from citypulse.operators.joins import join_dimension
    from citypulse.sources.warehouse import TERRITORIAL_ORDER
    df = join_dimension(w.territorial, w.time_dim, "time_sk", bounded=True)
    df = keep_first(df, E.DEDUP_KEYS, TERRITORIAL_ORDER)
    return C.quality_profile(df, PROFILE_COLS)


@register("bi_kpi_alerts", "G18 G7 G8 G9",
          "kpi:s value:f target:f direction:s target_met:i",
          with_views("""
WITH k AS (
  SELECT 'punctuality_pct' AS kpi, (1 - sum(annule) / count(*)) * 100 AS value FROM mob_clean
  UNION ALL SELECT 'carbon_intensity_mean', avg(carbon_intensity) FROM eco_ci
  UNION ALL SELECT 'densite_accidents', sum(nb_accidents) / count(DISTINCT zone_sk) FROM safe_features),
t AS (SELECT * FROM (VALUES ('punctuality_pct', 80.0::DOUBLE, 'above'),
                            ('carbon_intensity_mean', 0.10::DOUBLE, 'below'),
                            ('densite_accidents', 10.0::DOUBLE, 'below')) v(kpi, target, direction))
SELECT kpi, value, target, direction,
       CASE WHEN (direction = 'above' AND value > target) OR (direction = 'below' AND value < target)
            THEN 1 ELSE 0 END AS target_met
FROM k JOIN t USING (kpi)""", "mob_clean", "eco_ci", "safe_features"))
def bi_kpi_alerts(w):
    """Executive KPIs against their targets (punctuality > 80 %, carbon
    intensity < 0.10, accident density < 10) with a met flag."""
    p = M.punctuality(M.clean_mobility(w)).select(F.lit("punctuality_pct").alias("kpi"),
                                                  F.col("punctuality_pct").alias("value"))
    c = E.carbon_intensity_rows(E.clean_territorial(w)).agg(
        F.lit("carbon_intensity_mean").alias("kpi"), F.avg("carbon_intensity").alias("value"))
    s = SF.safety_kpis(SF.severity_features(SF.clean_safety(w))).select(
        F.lit("densite_accidents").alias("kpi"), F.col("densite_accidents").alias("value"))
    return B.kpi_alerts(p.unionByName(c).unionByName(s))


@register("bi_monthly_growth", "W12 F2 G3",
          "zone_sk:i annee_mois_dt:d co2_total:f mom_growth:f yoy_growth:f",
          with_views("""
WITH m AS (SELECT zone_sk, make_date(annee, mois, 1) AS annee_mois_dt, sum(co2_kg) AS co2_total
           FROM eco_clean GROUP BY ALL)
SELECT m.zone_sk, m.annee_mois_dt, m.co2_total,
       (m.co2_total - p.co2_total) / nullif(p.co2_total, 0) AS mom_growth,
       (m.co2_total - y.co2_total) / nullif(y.co2_total, 0) AS yoy_growth
FROM m LEFT JOIN m p ON p.zone_sk = m.zone_sk AND CAST(p.annee_mois_dt + INTERVAL 1 MONTH AS DATE) = m.annee_mois_dt
       LEFT JOIN m y ON y.zone_sk = m.zone_sk AND CAST(y.annee_mois_dt + INTERVAL 12 MONTH AS DATE) = m.annee_mois_dt""",
                     "eco_clean"))
def bi_monthly_growth(w):
    """Monthly CO2 per zone with month-over-month and year-over-year growth
    (calendar-keyed, gaps give NULL)."""
    clean = E.clean_territorial(w).withColumn("annee_mois_dt", F.make_date("annee", "mois", F.lit(1)))
    m = clean.groupBy("zone_sk", "annee_mois_dt").agg(F.sum("co2_kg").alias("co2_total"))
    return B.monthly_growth(m, "zone_sk", "annee_mois_dt", "co2_total")


@register("bi_drill_across", "J10 G1",
          "zone_sk:i co2_total:f n_trips:i n_accidents:i",
          with_views("""
WITH a AS (SELECT zone_sk, sum(co2_kg) AS co2_total FROM eco_clean GROUP BY zone_sk),
b AS (SELECT zone_sk, count(*) AS n_trips FROM mob_clean GROUP BY zone_sk),
c AS (SELECT zone_sk, sum(nb_accidents) AS n_accidents FROM safe_clean GROUP BY zone_sk)
SELECT coalesce(a.zone_sk, b.zone_sk, c.zone_sk) AS zone_sk, co2_total, n_trips, n_accidents
FROM a FULL JOIN b ON a.zone_sk = b.zone_sk
       FULL JOIN c ON coalesce(a.zone_sk, b.zone_sk) = c.zone_sk""", "eco_clean", "mob_clean",
                     "safe_clean"))
def bi_drill_across(w):
    """The facts aligned on the conformed zone dimension: CO2 total, trips,
    accidents per zone (full outer join of per-fact aggregates)."""
    a = E.clean_territorial(w).groupBy("zone_sk").agg(F.sum("co2_kg").alias("co2_total"))
    b = M.clean_mobility(w).groupBy("zone_sk").agg(F.count(F.lit(1)).alias("n_trips"))
    c = SF.clean_safety(w).groupBy("zone_sk").agg(F.sum("nb_accidents").alias("n_accidents"))
    return B.drill_across(B.drill_across(a, b, ["zone_sk"]), c, ["zone_sk"])


@register("bi_drill_through", "BI2",
          "fact_mob_sk:i zone_sk:i hour:i charge_estimee:f",
          with_views("""
SELECT fact_mob_sk, zone_sk, hour, charge_estimee FROM mob_features
WHERE zone_sk = 3 AND hour = 8""", "mob_features"))
def bi_drill_through(w):
    """The trips behind one cell (zone 3, hour 8) of the hotspot report."""
    return B.drill_through(M.engineer_features(M.clean_mobility(w)), zone_sk=3, hour=8)


@register("bi_row_level_security", "BI1 J8",
          "principal:s zone_sk:i n_trips:i n_cancelled:i",
          with_views("""
WITH e AS (SELECT ville AS principal, zone_sk FROM zone_dim),
k AS (SELECT zone_sk, count(*) AS n_trips, sum(annule) AS n_cancelled FROM mob_clean GROUP BY zone_sk)
SELECT e.principal, k.zone_sk, k.n_trips, k.n_cancelled FROM k JOIN e USING (zone_sk)
WHERE e.principal = 'EUROPE'""", "zone_dim", "mob_clean"))
def bi_row_level_security(w):
    """Row-level security: the per-zone trip KPIs a regional principal
    ('EUROPE') may see, via an entitlement table and a semi join."""
    ent = B.region_entitlements(w.zone_dim)
    k = M.punctuality(M.clean_mobility(w), ["zone_sk"]).select("zone_sk", "n_trips", "n_cancelled")
    view = B.secure_view(k, ent, "EUROPE")
    return view.withColumn("principal", F.lit("EUROPE"))


@register("bi_dynamic_security", "BI1 J8",
          "principal:s n_trips:i n_cancelled:i n_zones:i",
          with_views("""
WITH p(principal) AS (VALUES ('alice'), ('bob'), ('carol')),
e AS (SELECT 'alice' AS principal, zone_sk FROM zone_dim WHERE ville = 'EUROPE'
      UNION SELECT 'bob', zone_sk FROM zone_dim WHERE ville = 'ASIA' OR zone_sk = 3)
SELECT p.principal, count(m.fact_mob_sk) AS n_trips, coalesce(sum(m.annule), 0) AS n_cancelled,
       count(DISTINCT m.zone_sk) AS n_zones
FROM p LEFT JOIN e USING (principal) LEFT JOIN mob_clean m ON m.zone_sk = e.zone_sk GROUP BY p.principal""",
                     "zone_dim", "mob_clean"))
def bi_dynamic_security(w):
    """Row-level security by the session's principal: what alice (a region), bob
    (a region and a zone) and carol (no right) see of the same trips."""
    grants = w.spark.createDataFrame([("alice", "region", "EUROPE"), ("bob", "region", "ASIA"), ("bob", "zone", "3")],
                                     "principal string, kind string, value string")
    trips = M.clean_mobility(w)
    ent = B.role_entitlements(w.zone_dim, grants)
    seen = []
    for who in ("alice", "bob", "carol"):
        B.act_as(w.spark, who)
        seen.append(B.secured(trips, ent).agg(
            F.count(F.lit(1)).alias("n_trips"), F.coalesce(F.sum("annule"), F.lit(0)).alias("n_cancelled"),
            F.countDistinct("zone_sk").alias("n_zones")).withColumn("principal", F.lit(who)))
    B.act_as(w.spark, None)
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@register("ref_orphan_parts", "J11 IO5",
          "n_lines:i n_orphans:i",
          """
SELECT count(*) AS n_lines,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)) AS n_orphans
FROM lineitem""")
def ref_orphan_parts(w):
    """Referential check: line items whose part key has no part row."""
    li = w.table("lineitem").select("l_partkey")
    o = orphans(li, w.table("part"), "l_partkey", "p_partkey")
    return li.agg(F.count(F.lit(1)).alias("n_lines")).select(
        "n_lines", o.agg(F.count(F.lit(1)).alias("c")).select("c").scalar().alias("n_orphans"))


@register("eco_months_with_features", "J8 U2",
          "zone_sk:i n_months:i",
          with_views("""
WITH m AS (SELECT DISTINCT zone_sk, make_date(annee, mois, 1) AS d FROM eco_clean),
f AS (SELECT DISTINCT zone_sk, annee_mois_dt AS d FROM eco_features)
SELECT zone_sk, count(*) AS n_months FROM m WHERE EXISTS (
  SELECT 1 FROM f WHERE f.zone_sk = m.zone_sk AND f.d = m.d) GROUP BY zone_sk""",
                     "eco_clean", "eco_features"))
def eco_months_with_features(w):
    """Zone months of the clean facts that also have regression features
    (semi join on distinct (zone, month) pairs)."""
    clean = E.clean_territorial(w)
    m = clean.select("zone_sk", F.make_date("annee", "mois", F.lit(1)).alias("d")).distinct()
    f = E.engineer_features(clean).select("zone_sk", F.col("annee_mois_dt").alias("d")).distinct()
    return semi(m, f, ["zone_sk", "d"]).groupBy("zone_sk").agg(F.count(F.lit(1)).alias("n_months"))


DESCRIBED = M.NUMERIC


@register("mob_describe", "P25", "measure:s statistic:s value:f",
          with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS measure, s.statistic, s.value FROM (
  SELECT count({c})::DOUBLE AS a, avg({c}) AS b, stddev_samp({c}) AS c, min({c}) AS d, quantile_cont({c}, 0.25) AS e,
         quantile_cont({c}, 0.5) AS f, quantile_cont({c}, 0.75) AS g, max({c}) AS h FROM mob_clean) t,
LATERAL (VALUES ('count', a), ('mean', b), ('std', c), ('min', d), ('25%', e), ('50%', f), ('75%', g), ('max', h))
  s(statistic, value)""" for c in DESCRIBED), "mob_clean"))
def mob_describe(w):
    """describe() of every numeric trip measure, with exact quartiles."""
    return C.describe(M.clean_mobility(w), DESCRIBED)


@register("safety_report", "M15 IO9 P22",
          "section:s status:s n_fields:i overall:s generated_at:s")
def safety_report(w):
    """Evaluation report, section by section, with an overall status."""
    from citypulse.sources.sinks import build_report
    f = SF.severity_features(SF.clean_safety(w))
    report = build_report(w.spark, {
        "kpis": lambda: SF.safety_kpis(f),
        "classes": lambda: SF.class_distribution(f).groupBy().pivot("severity_class").agg(F.first("n"))})
    return C.audit_columns(report.withColumn("n_fields", F.size(F.json_object_keys("metrics"))), "1970-01-01 00:00:00 UTC")


@register("mob_scoring_imputation", "P13",
          "fact_mob_sk:i vitesse_kmh:f stress_1_5:f",
          with_views("""
SELECT fact_mob_sk, coalesce(vitesse_kmh, (SELECT median(vitesse_kmh) FROM mob_clean)) AS vitesse_kmh,
       coalesce(stress_1_5, (SELECT median(stress_1_5) FROM mob_clean)) AS stress_1_5
FROM mob_clean""", "mob_clean"))
def mob_scoring_imputation(w):
    """Scoring-time imputation: missing speed / stress replaced by the
    global (exact) median of the scored table."""
    from citypulse.operators.ordered import global_quantile
    c = M.clean_mobility(w)
    return c.select("fact_mob_sk",
                    F.coalesce("vitesse_kmh", global_quantile(c, "vitesse_kmh", 0.5)).alias("vitesse_kmh"),
                    F.coalesce("stress_1_5", global_quantile(c, "stress_1_5", 0.5)).alias("stress_1_5"))


@register("bi_export_roundtrip", "IO6 IO7 IO9 IO10 IO13 P22 BI5",
          "name:s present:i n_rows:i ok:i")
def bi_export_roundtrip(w):
    """Writes the severity predictions for BI (CSV with header, partitioned
    by year, conformed keys and audit column) and a JSON KPI report into the
    shared checkpoint folder, reads both back and verifies presence and row
    counts."""
    import uuid

    from citypulse.operators.materialize import stage
    from citypulse.plans import training as TR
    from citypulse.session import ensure_checkpoint_dir
    from citypulse.sources.sinks import read_report, verify_outputs, write_bi_table, write_report
    spark = w.spark
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/exports-{uuid.uuid4().hex[:8]}"
    f = SF.severity_features(SF.clean_safety(w))
    out = C.audit_columns(stage(TR.safe_severity_predictions(f), "predictions"), "1970-01-01 00:00:00 UTC")
    n = out.count()
    write_bi_table(out, f"{base}/severity_predictions", "csv", partition_by="annee")
    write_report(SF.safety_kpis(f), f"{base}/metrics_report")
    rep_rows = read_report(spark, f"{base}/metrics_report").count()
    v = verify_outputs(spark, {"severity_predictions": (f"{base}/severity_predictions", n)})
    return v.select("name", F.col("present").cast("int").alias("present"), "n_rows",
                    F.col("ok").cast("int").alias("ok")).unionByName(
        spark.createDataFrame([("metrics_report", 1, rep_rows, int(rep_rows == 1))],
                              "name string, present int, n_rows long, ok int"))
