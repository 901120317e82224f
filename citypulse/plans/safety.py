"""Safety plan: territorial facts -> severity labels and features, zone risk
profiles, KPIs, and the precision@k check of anomaly scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions import scalar as S
from citypulse.operators import clean as C
from citypulse.operators.dedup import keep_first
from citypulse.operators.encode import dense_codes
from citypulse.operators.joins import join_dimension
from citypulse.operators.materialize import materialize
from citypulse.operators.ordered import ordered_index
from citypulse.sources.warehouse import TERRITORIAL_ORDER, Warehouse

DEDUP_KEYS = ["time_sk", "zone_sk", "mode_sk"]
DROP = ["weather_sk", "event_sk", "energie_kwh", "co2_kg", "pm25", "no2", "aqi_index"]
# The reference's column list.
KEEP = [
    "fact_impact_sk", "time_sk", "zone_sk", "mode_sk",
    "nb_accidents", "nb_graves", "nb_mortels",
    "usagers_vulnerables", "volume_crimes", "taux_criminalite",
    "annee", "mois", "jour_semaine", "periode",
    "zone_nom", "zone_code", "ville",
]
NUMERIC = ["nb_accidents", "nb_graves", "nb_mortels", "usagers_vulnerables",
           "volume_crimes", "taux_criminalite"]
MIN_MORTEL_SAMPLES = 40
# Severity labels of the reference.
SEVERITY_LABELS = {0: "Aucun incident", 1: "Accident grave", 2: "Accident mortel"}
# The reference's column list.
PROFILE_MEANS = ["nb_accidents", "nb_graves", "nb_mortels", "volume_crimes",
                 "taux_criminalite", "usagers_vulnerables", "gravite_index"]
# The reference's column list.
ANOMALY_FEATURES = ["volume_crimes", "nb_accidents", "taux_criminalite", "zone_sk", "mois"]
# The precision@k heuristic (summer months, high-accident zones).
HIGH_RISK_MONTHS = [6, 7, 8]
HIGH_RISK_ZONES = [3, 6, 10]


def clean_safety(w: Warehouse, dedup: bool = True, zone_dim: DataFrame | None = None) -> DataFrame:
    """P5 dedup (keep first in file order), P6 ``zone_sk <= 10``, P1/P2
    drops (``bak_*`` and the ecology measures), J1 time join, IO4/J2
    optional zone join, P3 keep-list, P7/P11 numeric coercion with 0 fill.
    The safety loader filters before joining, so the zone filter also
    prunes the dedup input."""
    df = w.territorial
    if dedup:
        df = keep_first(df, DEDUP_KEYS, [c for c in TERRITORIAL_ORDER if c in df.columns])
    df = C.valid_zone_filter(df, max_zone=10, strict_names=False)
    df = C.drop_prefixed(df, "bak_")
    df = C.drop_existing(df, DROP)
    df = join_dimension(df, w.time_dim, "time_sk", ["annee", "mois", "jour_semaine", "periode"], bounded=True)
    zones = w.zone_dim if zone_dim is None else zone_dim
    if zones is not None:
        df = join_dimension(df, zones, "zone_sk", ["zone_nom", "zone_code", "ville"])
    df = C.select_existing(df, KEEP + [c for c in TERRITORIAL_ORDER if c != "fact_impact_sk"])
    df = C.coerce_numeric(df, [c for c in NUMERIC if c != "taux_criminalite"], "int", fill=0)
    return C.coerce_numeric(df, ["taux_criminalite"], "double", fill=0.0)


def severity_features(df: DataFrame, min_fatal: int = MIN_MORTEL_SAMPLES, ddof: int = 1,
                      cut_lineage: bool = True) -> DataFrame:
    """P17 severity class (binary when fewer than ``min_fatal`` fatal rows,
    else 0/1/2 with the fatal override), P19 labels, P20 ``gravite_index``
    (half-even 4 digits), W6 codes, ``has_accident``, F12 crime-rate z-score
    (sample std by default, ``ddof=0`` for the notebook variant)."""
    stats = df.agg(F.struct(
        F.sum((F.col("nb_mortels") > 0).cast("long")).alias("n_fatal"),
        F.avg("taux_criminalite").alias("mu"),
        (F.stddev_samp("taux_criminalite") if ddof == 1 else F.stddev_pop("taux_criminalite"))
        .alias("sd")).alias("s")).select("s").scalar()
    serious = (F.col("nb_graves") > 0) | (F.col("nb_mortels") > 0)
    three = (F.when(F.col("nb_mortels") > 0, 2).when(F.col("nb_graves") > 0, 1).otherwise(0))
    cls = F.when(stats.getField("n_fatal") < min_fatal, serious.cast("int")).otherwise(three)
    out = df.withColumn("severity_class", cls.cast("int"))
    out = out.withColumn("severity_label", C.map_values("severity_class", SEVERITY_LABELS))
    out = out.withColumn("gravite_index", S.round_half_even(
        C.smoothed_ratio(F.col("nb_graves") + F.col("nb_mortels"), "nb_accidents"), 4))
    out = dense_codes(out, "zone_sk", "zone_encoded", bounded=True)
    out = dense_codes(out, "mode_sk", "mode_encoded", bounded=True)
    out = out.withColumn("has_accident", (F.col("nb_accidents") > 0).cast("int"))
    z = S.zscore("taux_criminalite", stats.getField("mu"), stats.getField("sd"))
    out = out.withColumn("crime_rate_scaled", S.round_half_even(z, 4))
    # stage output of the safety plan, read by the classifier, clustering,
    # anomaly and KPI jobs: cut the lineage once
    return materialize(out) if cut_lineage else out


def zone_risk_profile(features: DataFrame) -> DataFrame:
    """Per zone the mean of the seven risk measures and the first zone
    name / code / city in file order (``min_by`` on the row order, skipping
    missing names)."""
    order = F.struct(*[F.col(c) for c in TERRITORIAL_ORDER if c in features.columns])
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
              for c in ["zone_nom", "zone_code", "ville"] if c in features.columns]
    return features.groupBy("zone_sk").agg(*[F.avg(c).alias(c) for c in PROFILE_MEANS], *firsts)


def safety_kpis(features: DataFrame) -> DataFrame:
    """G9 + G11: accident density per zone, severity index and totals."""
    a = features.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("zone_sk").alias("n_zones"),
        F.sum("nb_accidents").alias("total_accidents"),
        F.sum("nb_graves").alias("total_graves"),
        F.sum("nb_mortels").alias("total_mortels"),
        F.sum("volume_crimes").alias("total_crimes"))
    return (a.withColumn("densite_accidents", F.col("total_accidents") / F.col("n_zones"))
             .withColumn("indice_de_gravite",
                         (F.col("total_graves") + F.col("total_mortels"))
                         / F.greatest(F.col("total_accidents"), F.lit(1))))


def class_distribution(features: DataFrame) -> DataFrame:
    """Rows per severity class with its label."""
    return features.groupBy("severity_class", "severity_label").agg(F.count(F.lit(1)).alias("n"))


def bottom_k(df: DataFrame, score: str, tiebreak: list[str], rate: float = 0.05,
             k: int | None = None) -> DataFrame:
    """The ``k = max(1, round(n * rate))`` rows with the smallest score
    (pandas ``nsmallest``, ties by row order). ``k`` grows with the data, so
    this is not a driver-side ``limit``: rows are numbered along the order by
    ``ordered_index`` (distributed) and filtered on the position."""
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    # Python's round() is half-even: bround
    kk = F.lit(k) if k is not None else F.greatest(F.lit(1), F.bround(n * rate, 0).cast("long"))
    idx = ordered_index(df, [score, *tiebreak], name="_rank")
    return idx.where(F.col("_rank") < kk).drop("_rank").withColumn("k", kk)


def precision_at_k(df: DataFrame, score: str, tiebreak: list[str], rate: float = 0.05,
                   months=HIGH_RISK_MONTHS, zones=HIGH_RISK_ZONES) -> DataFrame:
    """Share of the bottom-k rows that fall in the expected high-risk
    months or zones (the heuristic and its constants are parameters)."""
    top = bottom_k(df, score, tiebreak, rate)
    hit = F.col("mois").isin(list(months)) | F.col("zone_sk").isin(list(zones))
    return top.agg(F.first("k").alias("k"), F.sum(hit.cast("long")).alias("n_expected"),
                   (F.sum(hit.cast("long")) / F.first("k")).alias("precision_at_k"))


def zscore_outlier_score(df: DataFrame, features: list[str]) -> DataFrame:
    """A distance-from-centre anomaly score: minus the Euclidean norm of the
    population z-scores of ``features`` (lower = more anomalous, the sign
    convention of the isolation-forest decision score)."""
    from citypulse.operators.encode import pop_standardize
    z = pop_standardize(df, features, suffix="_z")
    norm = F.sqrt(sum((F.col(f"{c}_z") * F.col(f"{c}_z") for c in features), F.lit(0.0)))
    return z.withColumn("anomaly_score", -norm).drop(*[f"{c}_z" for c in features])
