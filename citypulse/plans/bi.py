"""BI-layer operators described by the reference's report model (README
only in the reference): KPI alerts, MoM / YoY growth, drill-across of the
two facts, row-level security, drill-through, referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The report's KPI targets (punctuality above 80 %, carbon
# intensity below 0.10, accident density below 10).
KPI_TARGETS = [("punctuality_pct", 80.0, "above"), ("carbon_intensity_mean", 0.10, "below"),
               ("densite_accidents", 10.0, "below")]


def kpi_alerts(kpis: DataFrame) -> DataFrame:
    """A long KPI table (kpi, value) joined to its targets -> met flag.
    The target table is a literal of three rows."""
    spark = kpis.sparkSession
    targets = spark.createDataFrame(KPI_TARGETS, "kpi string, target double, direction string")
    j = kpis.join(targets, "kpi")
    met = F.when(F.col("direction") == "above", F.col("value") > F.col("target")) \
           .otherwise(F.col("value") < F.col("target"))
    return j.withColumn("target_met", met.cast("int"))


def monthly_growth(monthly: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """Month-over-month and same-period-last-year growth through
    calendar-keyed self-joins (a missing previous month gives NULL, unlike a
    row ``lag`` that would silently skip the gap). One row per (key, month):
    the joins are on the key and a shifted month."""
    prev = monthly.select(key, F.add_months(month, 1).alias(month), F.col(value).alias("_prev_m"))
    last = monthly.select(key, F.add_months(month, 12).alias(month), F.col(value).alias("_prev_y"))
    out = monthly.join(prev, [key, month], "left").join(last, [key, month], "left")
    return (out.withColumn("mom_growth", F.try_divide(F.col(value) - F.col("_prev_m"), F.col("_prev_m")))
               .withColumn("yoy_growth", F.try_divide(F.col(value) - F.col("_prev_y"), F.col("_prev_y")))
               .drop("_prev_m", "_prev_y"))


def drill_across(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Two facts aggregated to their conformed keys, full outer join."""
    return a.join(b, keys, "full")


def region_entitlements(zone_dim: DataFrame) -> DataFrame:
    """BI1: a dynamic role per city/region: the principal sees its zones."""
    return zone_dim.select(F.col("ville").alias("principal"), "zone_sk")


def secure_view(table: DataFrame, entitlements: DataFrame, principal: str) -> DataFrame:
    """BI1: the rows a principal may see (``left_semi`` on its zones)."""
    allowed = entitlements.where(F.col("principal") == principal).select("zone_sk")
    return table.join(allowed, "zone_sk", "left_semi")


PRINCIPAL = "citypulse_principal"  # session variable that names who asks


def act_as(spark: SparkSession, principal: str | None) -> None:
    """BI1: sets the session's principal; without one it is ``current_user()``."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {PRINCIPAL} STRING DEFAULT NULL")
    if principal is not None:
        quoted = principal.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"SET VARIABLE {PRINCIPAL} = '{quoted}'")


def role_entitlements(zone_dim: DataFrame, grants: DataFrame) -> DataFrame:
    """BI1: (principal, zone_sk) of all roles of a principal. ``grants`` has rows
    (principal, kind, value): a static role names a zone, a dynamic one a region,
    whose zones follow the dimension as it stands."""
    zones = zone_dim.select("zone_sk", "ville")
    dynamic = grants.where("kind = 'region'").join(zones, F.col("value") == F.col("ville")).select("principal", "zone_sk")
    static = grants.where("kind = 'zone'").select("principal", F.col("value").try_cast("int").alias("zone_sk")).join(
        zones.select("zone_sk"), "zone_sk", "left_semi").select("principal", "zone_sk")
    return dynamic.unionByName(static).distinct()


def secured(table: DataFrame, entitlements: DataFrame) -> DataFrame:
    """BI1: the rows of ``table`` that the session's principal may see. The
    semi join stands on the rows, so whatever is grouped later sees no others."""
    who = F.coalesce(F.expr(PRINCIPAL), F.current_user())
    allowed = entitlements.where(F.col("principal") == who).select("zone_sk")
    return table.join(allowed, "zone_sk", "left_semi")


def drill_through(table: DataFrame, **filters) -> DataFrame:
    """BI2: the detail rows behind a report cell (equality filters)."""
    out = table
    for c, v in filters.items():
        out = out.where(F.col(c) == F.lit(v))
    return out
