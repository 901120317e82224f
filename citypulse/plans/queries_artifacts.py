"""Queries over written artifacts: a saved pipeline of preprocessing and model,
a nested evaluation report read back by path, a quarantining CSV source."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.operators.models.stages import MeanEncoder, MedianImputer, Standardizer
from citypulse.operators.splits import hash_unit_sql, random_split
from citypulse.plans import mobility as M
from citypulse.plans import safety as SF
from citypulse.plans import training as TR
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views
from citypulse.session import ensure_checkpoint_dir
from citypulse.sources import reports as R
from citypulse.sources.quarantine import read_quarantined
from citypulse.sources.warehouse import TERRITORIAL_ORDER


def _folder(w, name: str) -> str:
    return f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("mob_saved_pipeline", "E1 E2 E3 IO11 IO12 L14 P14",
          "fact_mob_sk:i zone_mean:f speed_scaled:f prediction:f", with_views(f"""
WITH s AS (SELECT *, ({hash_unit_sql('fact_mob_sk', 42)}) >= 0.2 AS train FROM mob_clean
           WHERE charge_estimee IS NOT NULL),
z AS (SELECT zone_sk, avg(charge_estimee) AS m FROM s WHERE train GROUP BY 1),
g AS (SELECT median(vitesse_kmh) AS med, avg(charge_estimee) AS overall FROM s WHERE train),
x AS (SELECT s.*, coalesce(vitesse_kmh, (SELECT med FROM g)) AS v FROM s),
f AS (SELECT avg(v) AS a, stddev_pop(v) AS d, regr_slope(charge_estimee, v) AS b,
             regr_intercept(charge_estimee, v) AS c FROM x WHERE train)
SELECT fact_mob_sk, coalesce(z.m, (SELECT overall FROM g)) AS zone_mean, (v - a) / d AS speed_scaled,
       c + b * v AS prediction
FROM f, x LEFT JOIN z USING (zone_sk) WHERE NOT train""", "mob_clean"))
def mob_saved_pipeline(w):
    """Encoder, imputer, standardiser and a linear load model fitted as one
    pipeline on the training trips, saved, reloaded, and applied to the others."""
    rows = random_split(M.clean_mobility(w).where("charge_estimee is not null"), "fact_mob_sk").select(
        "fact_mob_sk", "zone_sk", "vitesse_kmh", "charge_estimee", "is_test")
    steps = Pipeline(stages=[
        MeanEncoder(encodings={"zone_mean": ["zone_sk"]}, labelCol="charge_estimee"),
        MedianImputer(inputCols=["vitesse_kmh"], outputCols=["speed"]),
        Standardizer(inputCols=["speed", "absent_feature"], outputCols=["speed_scaled", "absent_scaled"]),
        VectorAssembler(inputCols=["speed_scaled"], outputCol="features"),
        LinearRegression(labelCol="charge_estimee", solver="normal")])
    path = _folder(w, "pipeline")
    steps.fit(rows.where("is_test = 0")).write().save(path)
    return PipelineModel.load(path).transform(rows.where("is_test = 1")).select(
        "fact_mob_sk", "zone_mean", "speed_scaled", "prediction")


# a path of the report and, in SQL, what stands there
REPORTED = {
    "$.metadata.overall_status": "'PARTIAL'",
    "$.classification_severity.n_classes": "(SELECT count(DISTINCT severity_class) FROM f)",
    "$.classification_severity.total_rows": "(SELECT count(*) FROM f)",
    "$.classification_severity.class_distribution[0].n":
        "(SELECT count(*) FROM f WHERE severity_class = (SELECT min(severity_class) FROM f))",
    "$.clustering_zones.k": "least(3, (SELECT count(DISTINCT zone_sk) FROM f))",
    "$.clustering_zones.n_zones": "(SELECT count(DISTINCT zone_sk) FROM f)",
    "$.clustering_zones.assignments[0].zone_sk": "(SELECT min(zone_sk) FROM f)",
    "$.anomaly_detection.total_rows": "(SELECT n FROM a)",
    "$.anomaly_detection.n_anomalies": "(SELECT k FROM a)",
    "$.kpis.n_zones": "(SELECT count(DISTINCT zone_sk) FROM f)",
    "$.kpis.total_rows": "(SELECT count(*) FROM f)",
    "$.kpis.total_accidents": "(SELECT sum(nb_accidents)::BIGINT FROM f)",
    "$.kpis.total_graves": "(SELECT sum(nb_graves)::BIGINT FROM f)",
    "$.kpis.total_mortels": "(SELECT sum(nb_mortels)::BIGINT FROM f)",
    "$.drift.error": "'UNRESOLVED_COLUMN.WITH_SUGGESTION'",
    "$.kpis.error": "NULL",
}


@register("safety_report_document", "M15 IO9 IO10", "path:s value:s", with_views("""
WITH f AS (SELECT * FROM safe_features),
a AS (SELECT count(*) AS n, greatest(1, CAST(round_even(count(*) * 0.05, 0) AS BIGINT)) AS k FROM f
      WHERE volume_crimes IS NOT NULL AND nb_accidents IS NOT NULL AND taux_criminalite IS NOT NULL
        AND zone_sk IS NOT NULL AND mois IS NOT NULL AND time_sk IS NOT NULL AND annee IS NOT NULL)
""" + " UNION ALL ".join(f"SELECT '{p}' AS path, CAST({v} AS VARCHAR) AS value" for p, v in REPORTED.items()),
    "safe_features"))
def safety_report_document(w):
    """The evaluation report with all its sections and one planted failure:
    classification and clustering come from a report of an earlier run, anomalies
    and KPIs are computed now, and both documents are merged by path."""
    f = SF.severity_features(SF.clean_safety(w))

    def classification():
        per = SF.class_distribution(f)
        return per.agg(F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("total_rows"), F.sort_array(
            F.collect_list(F.struct("severity_class", "severity_label", "n"))).alias("class_distribution"))

    def clustering():
        zones = TR.safe_ward(f)
        return zones.agg(F.count_distinct("ward_cluster").alias("k"), F.count(F.lit(1)).alias("n_zones"),
                         F.max("merge_height").alias("merge_height"),
                         F.sort_array(F.collect_list(F.struct("zone_sk", "ward_cluster"))).alias("assignments"))

    def anomalies():
        known = f.dropna(subset=SF.ANOMALY_FEATURES + ["time_sk", "annee"])
        low = SF.bottom_k(SF.zscore_outlier_score(known, SF.ANOMALY_FEATURES), "anomaly_score", TERRITORIAL_ORDER)
        n = known.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        return low.agg(F.lit("distance of z-scores, 5 %").alias("model"), F.count(F.lit(1)).alias("n_anomalies")).select(
            "*", n.alias("total_rows"), (F.col("n_anomalies") / n * 100).alias("anomaly_rate_pct"))

    def kpis():
        totals = ["total_rows", "n_zones", "total_accidents", "total_graves", "total_mortels", "total_crimes"]
        return SF.safety_kpis(f).withColumns({c: F.col(c).cast("long") for c in totals})

    path, moment = _folder(w, "report"), "1970-01-01 00:00:00 UTC"
    R.write_document(R.build_document(w.spark, {"classification_severity": classification, "clustering_zones": clustering,
                                                "kpis": lambda: f.select("not_yet_computed")}, moment), f"{path}/earlier")
    now = R.build_document(w.spark, {"anomaly_detection": anomalies, "kpis": kpis,
                                     "drift": lambda: f.select("reference_distribution")}, moment)
    R.write_document(R.merge_documents(R.read_document(w.spark, f"{path}/earlier"), now), f"{path}/merged")
    found = R.read_document(w.spark, f"{path}/merged")
    values = F.inline(F.array(*[F.struct(F.lit(p).alias("path"), R.at(p).alias("value")) for p in REPORTED]))
    return found.select(values)


SUPPLIER = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.IntegerType()),
                         T.StructField("s_acctbal", T.DoubleType())])


@register("csv_quarantine", "IO1 P7", "outcome:s n:i total:f", """
WITH t AS (SELECT *, CASE s_suppkey % 10 WHEN 3 THEN 'malformed row' WHEN 5 THEN 's_acctbal: not a double'
                          WHEN 7 THEN 's_nationkey: missing' ELSE 'kept' END AS outcome FROM supplier)
SELECT outcome, count(*) AS n, sum(CASE WHEN outcome = 'kept' THEN s_acctbal END) AS total FROM t GROUP BY 1
UNION ALL SELECT 'rows', count(*), NULL FROM t""")
def csv_quarantine(w):
    """Suppliers written as two sets of CSV files with different headers and
    planted bad rows, read back with the bad ones in a reject table."""
    path = _folder(w, "supplier")
    kind = F.pmod("s_suppkey", F.lit(10))
    key = F.col("s_suppkey").cast("string")
    nation = F.when(kind == 7, "NULL").otherwise(F.col("s_nationkey").cast("string"))
    balance = F.when(kind == 5, "n/a").otherwise(F.col("s_acctbal").cast("string"))
    extra = F.when(kind == 3, ",x,y").otherwise("")
    t = w.table("supplier")
    sets = [("s_suppkey,s_nationkey,s_acctbal", [key, nation, balance], 0),
            (" S_AcctBal ,comment,nation,s_suppkey", [balance, F.lit('"a, b"'), nation, key], 1)]
    for i, (header, cols, odd) in enumerate(sets):
        # the header is the first line of every file: one per partition of the writer
        lines = t.where(F.pmod("s_nationkey", F.lit(2)) == odd).select(
            F.concat(F.concat_ws(",", *cols), extra).alias("line"))
        lines.select(F.col("line").alias(header)).write.options(
            header=True, sep="\x01", quote="\x02", escapeQuotes=False, ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False).csv(f"{path}/{i}")
    kept, rejects = read_quarantined(w.spark, f"{path}/*", SUPPLIER, ["s_suppkey", "s_nationkey"],
                                     {"nation": "s_nationkey"})
    good = kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("n"), F.sum("s_acctbal").alias("total"))
    bad = rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"),
                                                                F.lit(None).cast("double").alias("total"))
    found = good.unionByName(bad)
    every = found.agg(F.lit("rows").alias("outcome"), F.sum("n").alias("n"), F.lit(None).cast("double").alias("total"))
    return found.unionByName(every)
