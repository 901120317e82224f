"""The urban-mobility warehouse, derived from the driver tables.

The reference facts are not shipped, so the fact and dimension tables of the
galaxy schema are derived here (FIXTURES.md part B). These functions only
shape rows into the schemas the jobs expect; every job downstream works on
any data of these schemas.

* ``territorial_fact`` - fact_impact_territorial, one row per lineitem
  (lineitem -> orders -> customer). It keeps the lineitem identity columns as
  the file-order key (``TERRITORIAL_ORDER``), used wherever the reference
  relies on row order.
* ``territorial_time_dim`` / ``zone_dim`` - monthly time dimension and zones.
* ``mobility_fact`` / ``mobility_time_dim`` - fact_service_mobilite from
  ``events`` and its hourly time dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.sources.tables import read_table

# Total order standing in for the reference's file order (row id + tiebreaks).
# ``fact_impact_sk`` = l_orderkey*8 + l_linenumber is the row id; it is not
# unique in the driver data, so the rest of the lineitem identity follows.
TERRITORIAL_ORDER = [
    "fact_impact_sk", "l_partkey", "l_suppkey", "l_shipdate",
    "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus",
]


def territorial_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Orders meet their customers first, so the lineitems move once, by the order
    # key; no hand-placed broadcast: both sides grow with the data.
    bought = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    j = li.join(bought, li.l_orderkey == F.col("o_orderkey"))
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("fact_impact_sk"),
        *TERRITORIAL_ORDER[1:],
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int").alias("time_sk"),
        (F.col("c_nationkey") + 1).cast("int").alias("zone_sk"),
        F.when(F.col("l_returnflag") == "A", 2)
         .when(F.col("l_returnflag") == "N", 3)
         .when(F.col("l_returnflag") == "R", 5).cast("int").alias("mode_sk"),
        F.lit(None).cast("int").alias("weather_sk"),
        F.lit(None).cast("int").alias("event_sk"),
        F.when(F.col("l_linenumber") == 6, F.lit(0.0))
         .otherwise(F.col("l_quantity")).alias("energie_kwh"),
        F.when(F.col("l_linenumber") == 7, F.lit(0.0))
         .otherwise(F.col("l_extendedprice") / 100).alias("co2_kg"),
        (F.lit(20.0) + F.col("l_discount") * 400).alias("aqi_index"),
        (F.lit(5.0) + F.col("l_tax") * 200).alias("pm25"),
        (F.lit(10.0) + F.pmod(pk, F.lit(40))).cast("double").alias("no2"),
        F.when(F.pmod(pk, F.lit(10)) == 0, 1 + F.pmod(sk, F.lit(2)))
         .otherwise(0).cast("int").alias("nb_accidents"),
        F.when(F.pmod(pk, F.lit(70)) == 0, 1).otherwise(0).alias("nb_graves"),
        F.when(F.pmod(pk, F.lit(500)) == 0, 1).otherwise(0).alias("nb_mortels"),
        F.when(F.pmod(pk, F.lit(30)) == 0, 1).otherwise(0).alias("usagers_vulnerables"),
        (F.lit(20) + F.pmod(sk, F.lit(13))).cast("int").alias("volume_crimes"),
        (F.lit(0.5) + F.col("l_tax") * 10).alias("taux_criminalite"),
        F.col("l_quantity").alias("bak_energie_kwh"),
    )


def territorial_time_dim(spark: SparkSession) -> DataFrame:
    """Monthly time dimension: a generated calendar of 200 years (2,400 rows),
    so it costs no pass over the fact and is safe to broadcast."""
    m = spark.range(200 * 12).select((F.floor(F.col("id") / 12) + 1900).cast("int").alias("annee"),
                                     (F.pmod("id", F.lit(12)) + 1).cast("int").alias("mois"))
    return m.select((F.col("annee") * 100 + F.col("mois")).cast("int").alias("time_sk"), "annee", "mois")


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones from nations; nations 20+ play the reference's phantom UNKNOWN zone."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(
                 (F.col("n_nationkey") + 1).cast("int").alias("zone_sk"),
                 F.when(F.col("n_nationkey") >= 20, F.lit("UNKNOWN"))
                  .otherwise(F.concat(F.lit("  "), F.col("n_name"))).alias("zone_nom"),
                 F.concat(F.lit("Z"), F.col("n_nationkey").cast("string")).alias("zone_code"),
                 F.col("r_name").alias("ville"),
             ))


def _event_k(df: DataFrame):
    return F.get_json_object(df.props, "$.k").cast("int")


def mobility_time_dim(spark: SparkSession) -> DataFrame:
    """Hourly time dimension: a generated calendar from 2020 to 2029 (87,672
    rows), so it costs no pass over the fact and is safe to broadcast."""
    h = spark.range(3653 * 24).select(F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2020-01-01").cast(
        "timestamp_ntz")).alias("hts"))
    hour = F.hour("hts")
    return h.select(
        F.date_format("hts", "yyyyMMddHH").cast("long").alias("time_sk"),
        F.year("hts").cast("int").alias("annee"),
        F.month("hts").cast("int").alias("mois"),
        F.dayofmonth("hts").cast("int").alias("jour"),
        F.date_format("hts", "HH:mm:ss").alias("heure"),
        F.date_format("hts", "EEEE").alias("jour_semaine"),
        F.when(hour < 6, "nuit").when(hour < 12, "matin")
         .when(hour < 18, "apres-midi").otherwise("soir").alias("periode"),
        F.when(F.weekday("hts") >= 5, "1").otherwise("0").alias("weekend"),
    )


def mobility_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = _event_k(ev)
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("fact_mob_sk"),
        F.date_format(F.date_trunc("hour", "ts").cast("timestamp_ntz"), "yyyyMMddHH")
         .cast("long").alias("time_sk"),
        (F.pmod("user_id", F.lit(10)) + 1).cast("int").alias("zone_sk"),
        F.col("user_id").alias("line_sk"),
        F.when(et == "click", 1).when(et == "view", 2).when(et == "purchase", 3)
         .when(et == "signup", 4).when(et == "error", 5).cast("int").alias("mode_sk"),
        (F.pmod("user_id", F.lit(180)) + 1).cast("int").alias("stop_sk"),
        F.lit(None).cast("int").alias("event_sk"),
        F.lit(None).cast("int").alias("weather_sk"),
        F.when((et == "error") & (k < 10), 1).otherwise(0).alias("annule"),
        F.col("value").alias("charge_estimee"),
        k.cast("double").alias("vitesse_kmh"),
        (F.pmod(k, F.lit(45)) + 5).cast("double").alias("temps_trajet_min"),
        (k / F.lit(10.0).cast("double")).alias("congestion_index"),
        F.when(F.pmod(k, F.lit(33)) == 0, F.lit(None))
         .otherwise(F.pmod(k, F.lit(5)) + 1).cast("double").alias("stress_1_5"),
        (F.pmod("event_id", F.lit(5)) + 1).cast("double").alias("satisfaction_1_5"),
        k.cast("double").alias("bak_vitesse_kmh"),
    )


def scored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth/score pairs for the metric and curve operators (FIXTURES B.4)."""
    ev = read_table(spark, sf_dir, "events")
    k = _event_k(ev)
    return ev.select(
        F.col("event_id").alias("id"),
        F.when((F.col("event_type") == "error") & (k < 10), 1).otherwise(0).alias("y_true"),
        (k / F.lit(100.0).cast("double")).alias("score"),
    )


class Warehouse:
    """The galaxy schema as lazily built DataFrames (nothing is computed here)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.territorial = territorial_fact(spark, sf_dir)
        self.time_dim = territorial_time_dim(spark)
        self.zone_dim = zone_dim(spark, sf_dir)
        self.mobility = mobility_fact(spark, sf_dir)
        self.mobility_time_dim = mobility_time_dim(spark)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)
