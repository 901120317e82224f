"""Queries that run model-side operators on deterministic inputs, so that each
has a SQL oracle: bands, clipping, encodings, medians, cluster metrics on a
fixed assignment, correlation, holidays, KPSS, CSV sources, NULL group keys."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from citypulse.functions import scalar as S
from citypulse.operators import clean as C
from citypulse.operators import joins as J
from citypulse.operators.encode import TargetEncoder
from citypulse.operators.models import cluster as CL
from citypulse.operators.models.common import train_medians
from citypulse.operators.ordered import exact_quantiles, ordered_index
from citypulse.operators.splits import hash_unit_sql, random_split
from citypulse.plans import ecology as E
from citypulse.plans import mobility as M
from citypulse.plans import training as TR
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views
from citypulse.session import ensure_checkpoint_dir
from citypulse.sources import tables as T
from citypulse.sources.warehouse import scored_trips
from citypulse.timeseries.stationarity import kpss


@register("scored_risk_bands", "P18 L14", "risk_label:s n:i", with_views("""
SELECT CASE WHEN score < 0.2 THEN 'Low' WHEN score < 0.5 THEN 'Medium' ELSE 'High' END AS risk_label, count(*) AS n
FROM scored WHERE score IS NOT NULL GROUP BY 1""", "scored"))
def scored_risk_bands(w):
    """Trips per risk band of their score."""
    s = scored_trips(w.spark, w.sf_dir).where("score is not null")
    return s.withColumn("risk_label", C.threshold_band("score")).groupBy("risk_label").agg(F.count(F.lit(1)).alias("n"))


@register("mob_clipped_congestion", "P15", "fact_mob_sk:i congestion:f", with_views("""
SELECT fact_mob_sk, CASE WHEN congestion_index < 1 THEN 1 WHEN congestion_index > 8 THEN 8 ELSE congestion_index END
  AS congestion FROM mob_clean""", "mob_clean"))
def mob_clipped_congestion(w):
    """Congestion clipped to [1, 8]; missing stays missing."""
    return M.clean_mobility(w).select("fact_mob_sk", C.clip("congestion_index", 1.0, 8.0).alias("congestion"))


@register("eco_correlations", "G14", "a:s b:s corr:f", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM eco_features"
    for a in ("co2_kg", "energie_kwh", "aqi_index", "pm25", "no2")
    for b in ("co2_kg", "energie_kwh", "aqi_index", "pm25", "no2")), "eco_features"))
def eco_correlations(w):
    """Pearson correlation matrix of the pollution measures."""
    return TR.eco_correlations(E.engineer_features(E.clean_territorial(w)))


@register("null_group_positions", "W4", "grp:i pos:i n:i", with_views("""
WITH t AS (SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE id % 4 END AS grp FROM scored),
r AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY id) - 1 AS p FROM t)
SELECT grp, p // 100 AS pos, count(*) AS n FROM r GROUP BY ALL""", "scored"))
def null_group_positions(w):
    """Row positions per group, the missing key being a group of its own."""
    t = scored_trips(w.spark, w.sf_dir).select("id", F.nullif(F.pmod("id", F.lit(4)), F.lit(0)).alias("grp"))
    p = ordered_index(t, ["id"], ["grp"], name="p")
    return p.groupBy("grp", F.floor(F.col("p") / 100).alias("pos")).agg(F.count(F.lit(1)).alias("n"))


@register("null_group_medians", "P12", "grp:i median:f", with_views("""
SELECT CASE WHEN id % 4 = 0 THEN NULL ELSE id % 4 END AS grp, median(score) AS median FROM scored GROUP BY 1""",
                                                               "scored"))
def null_group_medians(w):
    """Exact median per group, the missing key being a group of its own."""
    t = scored_trips(w.spark, w.sf_dir).select("score", F.nullif(F.pmod("id", F.lit(4)), F.lit(0)).alias("grp"))
    return exact_quantiles(t, "score", {"median": 0.5}, by=["grp"])


TRAIN = f"({hash_unit_sql('fact_mob_sk', 42)}) >= 0.2"


@register("mob_train_medians", "P14", "feature:s median:f", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, median({c}) AS median FROM mob_clean WHERE {TRAIN}"
    for c in ("vitesse_kmh", "stress_1_5", "temps_trajet_min")), "mob_clean"))
def mob_train_medians(w):
    """Medians that the model imputer learns from the training rows."""
    train = random_split(M.clean_mobility(w), "fact_mob_sk").where("is_test = 0")
    found = train_medians(train, ["vitesse_kmh", "stress_1_5", "temps_trajet_min"])
    return w.spark.createDataFrame(sorted(found.items()), "feature string, median double")


@register("mob_reloaded_encodings", "IO12 E2", "fact_mob_sk:i zone_mean:f", with_views("""
SELECT t.fact_mob_sk, coalesce(z.m, (SELECT avg(charge_estimee) FROM mob_clean WHERE mode_sk = 1)) AS zone_mean
FROM mob_clean t LEFT JOIN (SELECT zone_sk, avg(charge_estimee) AS m FROM mob_clean WHERE mode_sk = 1 GROUP BY 1) z
USING (zone_sk)""", "mob_clean"))
def mob_reloaded_encodings(w):
    """Zone load encoding learnt on one mode, saved, reloaded and applied."""
    trips = M.clean_mobility(w)
    path = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/encodings-{uuid.uuid4().hex}"
    maps = {"zone_mean": ["zone_sk"]}
    TargetEncoder(maps, "charge_estimee").fit(trips.where("mode_sk = 1")).save(path)
    enc = TargetEncoder.load(w.spark, path, maps, "charge_estimee")
    return enc.transform(trips).select("fact_mob_sk", "zone_mean")


FIXED = """
WITH p AS (SELECT *, zone_sk % 3 AS cluster_id FROM eco_features),
c AS (SELECT cluster_id, avg(co2_kg) AS x, avg(pm25) AS y FROM p GROUP BY 1)"""


@register("cluster_centroids_fixed", "G13 M10", "cluster_id:i x:f y:f inertia:f", with_views(FIXED + """,
s AS (SELECT sum((co2_kg - x) ** 2 + (pm25 - y) ** 2) AS inertia FROM p JOIN c USING (cluster_id))
SELECT cluster_id, x, y, (SELECT inertia FROM s) AS inertia FROM c""", "eco_features"))
def cluster_centroids_fixed(w):
    """Centroids and inertia of a fixed assignment of the feature rows."""
    a = E.engineer_features(E.clean_territorial(w)).withColumn("cluster_id", F.pmod("zone_sk", F.lit(3)))
    cents = a.groupBy("cluster_id").agg(F.avg("co2_kg").alias("x"), F.avg("pm25").alias("y"))
    return cents.withColumn("inertia", CL.inertia(a, ["co2_kg", "pm25"]).select("inertia").scalar())


@register("cluster_davies_bouldin_fixed", "M11", "davies_bouldin:f", with_views(FIXED + """,
s AS (SELECT cluster_id, avg(sqrt((co2_kg - x) ** 2 + (pm25 - y) ** 2)) AS sc, any_value(x) AS x, any_value(y) AS y
      FROM p JOIN c USING (cluster_id) GROUP BY 1),
r AS (SELECT a.cluster_id, max((a.sc + b.sc) / sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS r
      FROM s a JOIN s b ON a.cluster_id <> b.cluster_id GROUP BY 1)
SELECT avg(r) AS davies_bouldin FROM r""", "eco_features"))
def cluster_davies_bouldin_fixed(w):
    """Davies-Bouldin index of a fixed assignment of the feature rows."""
    a = E.engineer_features(E.clean_territorial(w)).withColumn("cluster_id", F.pmod("zone_sk", F.lit(3)))
    return CL.davies_bouldin(a, ["co2_kg", "pm25"])


@register("cluster_silhouette_fixed", "M9", "silhouette:f n_zones:i", with_views("""
WITH z AS (SELECT zone_sk, zone_sk % 3 AS c, avg(co2_kg) AS x, avg(pm25) AS y FROM eco_features GROUP BY zone_sk),
d AS (SELECT a.zone_sk, a.c AS own, b.c AS other, sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS s, count(*) AS n
      FROM z a CROSS JOIN z b GROUP BY 1, 2, 3),
w AS (SELECT zone_sk, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
             min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY 1)
SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette,
       count(*) AS n_zones FROM w""", "eco_features"))
def cluster_silhouette_fixed(w):
    """Euclidean silhouette of a fixed assignment of the zones' mean profile."""
    prof = E.engineer_features(E.clean_territorial(w)).groupBy("zone_sk").agg(
        F.avg("co2_kg").alias("x"), F.avg("pm25").alias("y"))
    prof = prof.withColumn("cluster_id", F.pmod("zone_sk", F.lit(3)))
    return w.spark.createDataFrame([(CL.silhouette(prof, ["x", "y"]), prof.count())], "silhouette double, n_zones long")


@register("cluster_names_fixed", "L8", "zone_sk:i cluster_label:s", with_views("""
WITH z AS (SELECT zone_sk, avg(co2_kg) / 100 AS c, avg(pm25) / 20 AS p FROM eco_features GROUP BY 1)
SELECT zone_sk, CASE WHEN c > 0.4 AND p > 0.4 THEN 'High Emission & High Pollution'
  WHEN c > 0.4 THEN 'High Emission, Clean Air' WHEN p > 0.4 THEN 'High Pollution, Low Emission'
  ELSE 'Clean & Green Zone' END AS cluster_label FROM z""", "eco_features"))
def cluster_names_fixed(w):
    """Centroid-rule names of each zone's scaled means."""
    z = E.engineer_features(E.clean_territorial(w)).groupBy("zone_sk").agg(
        (F.avg("co2_kg") / 100).alias("co2_kg"), (F.avg("pm25") / 20).alias("pm25"))
    return CL.centroid_rule_labels(z).select("zone_sk", "cluster_label")


@register("fr_holiday_trips", "F13", "ds:d holiday:s n:i", """
WITH d AS (SELECT CAST(ts AS DATE) AS ds FROM events),
h AS (SELECT * FROM (VALUES (DATE '2024-01-01', 'Jour de l''an'), (DATE '2024-05-01', 'Fete du Travail'),
  (DATE '2024-05-08', 'Victoire 1945'), (DATE '2024-07-14', 'Fete nationale'), (DATE '2024-08-15', 'Assomption'),
  (DATE '2024-11-01', 'Toussaint'), (DATE '2024-11-11', 'Armistice 1918'), (DATE '2024-12-25', 'Noel'),
  (DATE '2024-04-01', 'Lundi de Paques'), (DATE '2024-05-09', 'Ascension'), (DATE '2024-05-20', 'Lundi de Pentecote'))
  v(ds, holiday))
SELECT h.ds, h.holiday, count(d.ds) AS n FROM h LEFT JOIN d USING (ds) GROUP BY ALL""")
def fr_holiday_trips(w):
    """Trips on each French public holiday of 2024."""
    per_day = w.table("events").groupBy(F.to_date(F.col("ts").cast("timestamp_ntz")).alias("ds")).agg(
        F.count(F.lit(1)).alias("c"))
    return S.fr_holidays(w.spark, 2024, 2024).join(per_day, "ds", "left").select(
        "ds", "holiday", F.coalesce("c", F.lit(0)).alias("n"))


@register("eco_outer_merge", "J6", "zone_sk:i mean_co2:f mean_pm25:f n_trips:i", with_views("""
WITH a AS (SELECT zone_sk, avg(co2_kg) AS mean_co2 FROM eco_clean GROUP BY 1),
b AS (SELECT zone_sk, avg(pm25) AS mean_pm25 FROM eco_clean WHERE zone_sk > 4 GROUP BY 1),
c AS (SELECT zone_sk, count(*) AS n_trips FROM mob_clean WHERE zone_sk < 8 GROUP BY 1)
SELECT coalesce(a.zone_sk, b.zone_sk, c.zone_sk) AS zone_sk, mean_co2, mean_pm25, n_trips
FROM a FULL JOIN b ON a.zone_sk = b.zone_sk FULL JOIN c ON coalesce(a.zone_sk, b.zone_sk) = c.zone_sk""",
                                                    "eco_clean", "mob_clean"))
def eco_outer_merge(w):
    """Three per-zone results with different zones, merged by full outer joins."""
    eco = E.clean_territorial(w)
    return J.outer_merge([
        eco.groupBy("zone_sk").agg(F.avg("co2_kg").alias("mean_co2")),
        eco.where("zone_sk > 4").groupBy("zone_sk").agg(F.avg("pm25").alias("mean_pm25")),
        M.clean_mobility(w).where("zone_sk < 8").groupBy("zone_sk").agg(F.count(F.lit(1)).alias("n_trips"))], ["zone_sk"])


@register("csv_sources", "IO1 IO2 IO4 IO5", "zone_sk:i zone_nom:s n_suppliers:i", """
SELECT n_nationkey + 1 AS zone_sk, CASE WHEN n_nationkey = 2 THEN NULL ELSE '  ' || n_name END AS zone_nom,
       (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers FROM nation""")
def csv_sources(w):
    """Facts and a zone dimension written as CSV with quoted text and ``NULL``
    literals and read back with declared schemas; an optional dimension that is
    absent is skipped."""
    base = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    zones = w.table("nation").select(
        (F.col("n_nationkey") + 1).cast("int").alias("zone_sk"),
        F.when(F.col("n_nationkey") != 2, F.concat(F.lit("  "), F.col("n_name"))).alias("zone_nom"),
        F.lit(None).cast("string").alias("ville"), F.lit(None).cast("string").alias("region"),
        F.col("n_nationkey").cast("string").alias("zone_code"))
    writer = {"header": True, "nullValue": "NULL", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    zones.write.options(**writer).csv(f"{base}/dim_zone")
    facts = w.table("supplier").select((F.col("s_nationkey") + 1).cast("int").alias("zone_sk"))
    facts.write.options(**writer).csv(f"{base}/facts")
    read = T.read_csv(w.spark, f"{base}/dim_zone", T.DIM_ZONE_SCHEMA)
    rows = T.read_csv(w.spark, f"{base}/facts", facts.schema)
    if T.read_optional(w.spark, f"{base}/dim_arret", T.DIM_ARRET_SCHEMA) is not None:
        raise ValueError("an absent source must read as None")
    found = T.read_optional(w.spark, f"{base}/dim_zone", T.DIM_ZONE_SCHEMA)
    n = rows.groupBy("zone_sk").agg(F.count(F.lit(1)).alias("n_suppliers"))
    return read.join(found.select("zone_sk"), "zone_sk", "left_semi").join(n, "zone_sk", "left").select(
        "zone_sk", "zone_nom", F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"))


OVR = {0: "score", 1: "s1", 2: "s2"}


def _ovr_sql(c: int, score: str) -> str:
    return f"""
SELECT {c} AS class, (sum(CASE WHEN y = {c} THEN r END) - p * (p + 1) / 2) / (p * q) AS auc FROM (
  SELECT y, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS r,
         sum((y = {c})::INT) OVER () AS p, sum((y <> {c})::INT) OVER () AS q FROM t) GROUP BY p, q"""


@register("metrics_auc_ovr", "M7", "class:i auc:f", with_views(f"""
WITH t AS (SELECT id % 3 AS y, score, 1 - abs(score - 0.5) AS s1, 1 - score AS s2 FROM scored WHERE score IS NOT NULL),
a AS ({" UNION ALL ".join(_ovr_sql(c, s) for c, s in OVR.items())})
SELECT class, auc FROM a UNION ALL SELECT NULL, avg(auc) FROM a""", "scored"))
def metrics_auc_ovr(w):
    """One-vs-rest AUC per class and its macro mean."""
    from citypulse.operators.curves import roc_auc_ovr
    t = scored_trips(w.spark, w.sf_dir).where("score is not null").select(
        F.pmod("id", F.lit(3)).alias("y"), "score", (1 - F.abs(F.col("score") - 0.5)).alias("s1"),
        (1 - F.col("score")).alias("s2"))
    return roc_auc_ovr(t, "y", OVR)


@register("mob_kpss", "Y9", "zone_sk:i kpss_stat:f kpss_lag:i", with_views("""
WITH d AS (SELECT zone_sk, row_number() OVER (PARTITION BY zone_sk ORDER BY ds) AS t,
                  y - avg(y) OVER (PARTITION BY zone_sk) AS e, count(*) OVER (PARTITION BY zone_sk) AS n FROM mob_daily),
g AS (SELECT a.zone_sk, a.t - b.t AS j, any_value(a.n) AS n, sum(a.e * b.e) AS s FROM d a JOIN d b
      ON a.zone_sk = b.zone_sk AND a.t >= b.t GROUP BY 1, 2),
k AS (SELECT zone_sk, any_value(n) AS n, sum(CASE WHEN j = 0 THEN s / n ELSE 2 * s / n END) AS even,
             sum(j * 2 * s / n) AS by_lag FROM g WHERE j <= greatest(least(floor(n ** (2.0 / 9)), n - 1), 1) GROUP BY 1),
b AS (SELECT zone_sk, n, least(CAST(floor(1.1447 * ((by_lag / even) ** 2) ** (1.0 / 3) * n ** (1.0 / 3)) AS BIGINT), n - 1)
        AS lag FROM k),
v AS (SELECT b.zone_sk, any_value(b.lag) AS lag, any_value(b.n) AS n,
             sum(CASE WHEN j = 0 THEN s ELSE 2 * s * (1 - j / (b.lag + 1.0)) END) / any_value(b.n) AS lr
      FROM g JOIN b ON g.zone_sk = b.zone_sk WHERE j <= b.lag GROUP BY 1),
c AS (SELECT zone_sk, sum(e) OVER (PARTITION BY zone_sk ORDER BY t) AS cs FROM d),
e AS (SELECT zone_sk, sum(cs * cs) AS ss FROM c GROUP BY 1)
SELECT v.zone_sk, ss / (v.n * v.n) / lr AS kpss_stat, lag AS kpss_lag FROM v JOIN e ON v.zone_sk = e.zone_sk""",
                                          "mob_daily"))
def mob_kpss(w):
    """KPSS statistic and bandwidth of each zone's daily congestion."""
    d = M.daily_congestion(M.engineer_features(M.clean_mobility(w)))
    return kpss(d, ["zone_sk"], "ds", "y").select("zone_sk", "kpss_stat", "kpss_lag")
