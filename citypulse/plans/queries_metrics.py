"""Registered metric / curve / split queries (Spark plan + DuckDB oracle).

Truth / score pairs: the cancellation flag against a score derived from the
trip (``scored_trips``), CO2 against an energy-proportional prediction on
the ecology features, and the ``labels`` table's two 0/1 columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.operators import curves as CU
from citypulse.operators import metrics as MT
from citypulse.operators import splits as SP
from citypulse.plans import ecology as E
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views
from citypulse.sources.warehouse import scored_trips


def _eco_scored(w):
    f = E.engineer_features(E.clean_territorial(w))
    return f.withColumn("co2_pred", F.col("energie_kwh") * 15)


@register("metrics_regression_by_mode", "M1 M2",
          "mode_sk:i n:i rmse:f mae:f r2:f",
          with_views("""
SELECT mode_sk, count(*) AS n, sqrt(avg((co2_kg - co2_pred) * (co2_kg - co2_pred))) AS rmse,
       avg(abs(co2_kg - co2_pred)) AS mae,
       CASE WHEN var_pop(co2_kg) > 0 THEN 1 - sum((co2_kg - co2_pred) * (co2_kg - co2_pred))
            / (count(*) * var_pop(co2_kg)) END AS r2
FROM eco_scored GROUP BY mode_sk""", "eco_scored"))
def metrics_regression_by_mode(w):
    """RMSE / MAE / R² of a CO2 prediction, per transport mode."""
    return MT.regression_metrics(_eco_scored(w), "co2_kg", "co2_pred", by=["mode_sk"])


@register("metrics_regression_pooled", "M1 M4 M13",
          "n:i rmse:f mae:f r2:f mape:f mean_residual:f",
          with_views("""
SELECT count(*) AS n, sqrt(avg((co2_kg - co2_pred) * (co2_kg - co2_pred))) AS rmse,
       avg(abs(co2_kg - co2_pred)) AS mae,
       1 - sum((co2_kg - co2_pred) * (co2_kg - co2_pred)) / (count(*) * var_pop(co2_kg)) AS r2,
       avg(CASE WHEN co2_kg > 0 THEN abs((co2_kg - co2_pred) / co2_kg) END) AS mape,
       avg(co2_kg - co2_pred) AS mean_residual
FROM eco_scored""", "eco_scored"))
def metrics_regression_pooled(w):
    """Pooled RMSE / MAE / R², MAPE on positive actuals, mean residual."""
    s = _eco_scored(w)
    m = MT.regression_metrics(s, "co2_kg", "co2_pred")
    mp = MT.mape(s, "co2_kg", "co2_pred").select("mape").scalar()
    res = MT.residuals(s, "co2_kg", "co2_pred").agg(F.avg("residual").alias("r")).select("r").scalar()
    return m.select("n", "rmse", "mae", "r2", mp.alias("mape"), res.alias("mean_residual"))


@register("metrics_confusion_at_threshold", "M8 M16",
          "actual:i predicted:i n:i",
          with_views("""
WITH p AS (SELECT y_true, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS y_pred FROM scored),
g AS (SELECT a.v AS actual, b.v AS predicted FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v))
SELECT g.actual, g.predicted, count(p.y_true) AS n
FROM g LEFT JOIN p ON p.y_true = g.actual AND p.y_pred = g.predicted
GROUP BY g.actual, g.predicted""", "scored"))
def metrics_confusion_at_threshold(w):
    """Confusion matrix on the full 0/1 grid at threshold 0.5."""
    s = MT.threshold_predictions(scored_trips(w.spark, w.sf_dir), "score", 0.5)
    return MT.confusion_counts(s, "y_true", "y_pred", [0, 1])


@register("metrics_binary_scores", "M5 M16",
          "tp:i fp:i fn:i n:i precision:f recall:f f1:f accuracy:f",
          with_views("""
WITH p AS (SELECT y_true, CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS y_pred FROM scored),
c AS (SELECT sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y_true <> 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y_true = 1 AND y_pred <> 1 THEN 1 ELSE 0 END) AS fn,
             count(*) AS n, sum(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END) AS ok FROM p)
SELECT tp, fp, fn, n, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
       coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, ok / n AS accuracy FROM c""",
                     "scored"))
def metrics_binary_scores(w):
    """Precision / recall / F1 / accuracy at threshold 0.2 (zero division -> 0)."""
    s = MT.threshold_predictions(scored_trips(w.spark, w.sf_dir), "score", 0.2)
    return MT.binary_scores(s, "y_true", "y_pred")


@register("metrics_class_report", "M6",
          "class:i support:i precision:f recall:f f1:f",
          """
WITH c AS (SELECT DISTINCT quality AS cls FROM labels UNION SELECT DISTINCT toxic FROM labels),
t AS (SELECT quality AS cls, count(*) AS support, sum(CASE WHEN toxic = quality THEN 1 ELSE 0 END) AS tp
      FROM labels GROUP BY quality),
p AS (SELECT toxic AS cls, count(*) AS n_pred FROM labels GROUP BY toxic)
SELECT c.cls AS class, coalesce(support, 0) AS support,
       coalesce(coalesce(tp, 0) / nullif(coalesce(n_pred, 0), 0), 0) AS precision,
       coalesce(coalesce(tp, 0) / nullif(coalesce(support, 0), 0), 0) AS recall,
       coalesce(2 * coalesce(tp, 0) / nullif(coalesce(n_pred, 0) + coalesce(support, 0), 0), 0) AS f1
FROM c LEFT JOIN t USING (cls) LEFT JOIN p USING (cls)""")
def metrics_class_report(w):
    """Per-class precision / recall / F1 / support (labels: quality as truth,
    toxic as prediction)."""
    return MT.per_class_report(w.table("labels"), "quality", "toxic")


@register("metrics_f1_summary", "M6",
          "accuracy:f f1_macro:f f1_weighted:f n:i",
          """
WITH c AS (SELECT DISTINCT quality AS cls FROM labels UNION SELECT DISTINCT toxic FROM labels),
t AS (SELECT quality AS cls, count(*) AS support, sum(CASE WHEN toxic = quality THEN 1 ELSE 0 END) AS tp
      FROM labels GROUP BY quality),
p AS (SELECT toxic AS cls, count(*) AS n_pred FROM labels GROUP BY toxic),
r AS (SELECT coalesce(support, 0) AS support,
             coalesce(2 * coalesce(tp, 0) / nullif(coalesce(n_pred, 0) + coalesce(support, 0), 0), 0) AS f1
      FROM c LEFT JOIN t USING (cls) LEFT JOIN p USING (cls))
SELECT (SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) FROM labels) AS accuracy,
       avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted, sum(support) AS n FROM r""")
def metrics_f1_summary(w):
    """Accuracy, macro and support-weighted F1 (labels table)."""
    return MT.f1_summary(w.table("labels"), "quality", "toxic")


_CURVE = """
WITH s AS (SELECT score AS threshold, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN y_true <> 1 THEN 1 ELSE 0 END) AS neg
           FROM scored WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
             sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cum_neg FROM s),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s)
"""


@register("metrics_roc_auc", "M7 W10",
          "auc:f n_pos:i n_neg:i",
          with_views(_CURVE + """
SELECT sum(pos * ((N - cum_neg) + 0.5 * neg)) / (P * N) AS auc, max(P) AS n_pos, max(N) AS n_neg
FROM c, t GROUP BY P, N""", "scored"))
def metrics_roc_auc(w):
    """Exact ROC AUC (Mann-Whitney with mid-ranks) of the trip score."""
    return CU.roc_auc(scored_trips(w.spark, w.sf_dir), "y_true", "score")


@register("metrics_roc_curve", "W10",
          "threshold:f fpr:f tpr:f",
          with_views(_CURVE + """
SELECT threshold, cum_neg / N AS fpr, cum_pos / P AS tpr FROM c, t""", "scored"))
def metrics_roc_curve(w):
    """ROC curve points, one per distinct score (ties collapsed)."""
    return CU.roc_curve(scored_trips(w.spark, w.sf_dir), "y_true", "score")


@register("metrics_pr_curve", "W11",
          "threshold:f precision:f recall:f f1:f",
          with_views(_CURVE + """
SELECT threshold, cum_pos / (cum_pos + cum_neg) AS precision, cum_pos / P AS recall,
       CASE WHEN cum_pos / (cum_pos + cum_neg) + cum_pos / P > 0
            THEN 2 * (cum_pos / (cum_pos + cum_neg)) * (cum_pos / P)
                 / (cum_pos / (cum_pos + cum_neg) + cum_pos / P) ELSE 0 END AS f1
FROM c, t""", "scored"))
def metrics_pr_curve(w):
    """Precision / recall / F1 at every distinct score threshold."""
    return CU.pr_curve(scored_trips(w.spark, w.sf_dir), "y_true", "score")


@register("metrics_best_f1_threshold", "W11 T6 M16",
          "threshold:f precision:f recall:f f1:f",
          with_views(_CURVE + """
SELECT threshold, precision, recall, f1 FROM (
  SELECT threshold, cum_pos / (cum_pos + cum_neg) AS precision, cum_pos / P AS recall,
         CASE WHEN cum_pos / (cum_pos + cum_neg) + cum_pos / P > 0
              THEN 2 * (cum_pos / (cum_pos + cum_neg)) * (cum_pos / P)
                   / (cum_pos / (cum_pos + cum_neg) + cum_pos / P) ELSE 0 END AS f1
  FROM c, t) ORDER BY f1 DESC, threshold ASC LIMIT 1""", "scored"))
def metrics_best_f1_threshold(w):
    """The F1-maximising threshold (ties -> lowest threshold)."""
    return CU.best_f1_threshold(scored_trips(w.spark, w.sf_dir), "y_true", "score")


@register("metrics_contiguous_kfold", "X4 G16 M3",
          "fold:i n:i rmse:f",
          with_views("""
WITH o AS (SELECT *, row_number() OVER (ORDER BY zone_sk, mode_sk, annee_mois_dt, time_sk,
                                         fact_impact_sk) - 1 AS pos,
                  count(*) OVER () AS n FROM eco_scored),
f AS (SELECT *, n // 5 AS q, n - (n // 5) * 5 AS r FROM o),
g AS (SELECT *, CASE WHEN pos < r * (q + 1) THEN pos // (q + 1)
                     ELSE r + (pos - r * (q + 1)) // greatest(q, 1) END AS fold FROM f)
SELECT fold, count(*) AS n, sqrt(avg((co2_kg - co2_pred) * (co2_kg - co2_pred))) AS rmse
FROM g GROUP BY fold""", "eco_scored"))
def metrics_contiguous_kfold(w):
    """Unshuffled 5-fold split over the series order (first n % 5 folds one
    row bigger) and the RMSE of each fold."""
    s = SP.contiguous_kfold(_eco_scored(w), ["zone_sk", "mode_sk", "annee_mois_dt", "time_sk",
                                             "fact_impact_sk"], 5)
    return MT.regression_metrics(s, "co2_kg", "co2_pred", by=["fold"]).select("fold", "n", "rmse")


@register("metrics_fold_mean_std", "G16 M3",
          "mean:f std:f n:i",
          with_views("""
WITH o AS (SELECT *, row_number() OVER (ORDER BY zone_sk, mode_sk, annee_mois_dt, time_sk,
                                         fact_impact_sk) - 1 AS pos,
                  count(*) OVER () AS n FROM eco_scored),
f AS (SELECT *, n // 5 AS q, n - (n // 5) * 5 AS r FROM o),
g AS (SELECT *, CASE WHEN pos < r * (q + 1) THEN pos // (q + 1)
                     ELSE r + (pos - r * (q + 1)) // greatest(q, 1) END AS fold FROM f),
h AS (SELECT fold, sqrt(avg((co2_kg - co2_pred) * (co2_kg - co2_pred))) AS rmse FROM g GROUP BY fold)
SELECT avg(rmse) AS mean, stddev_pop(rmse) AS std, count(*) AS n FROM h""", "eco_scored"))
def metrics_fold_mean_std(w):
    """Mean and population std of the per-fold RMSE (CV summary)."""
    s = SP.contiguous_kfold(_eco_scored(w), ["zone_sk", "mode_sk", "annee_mois_dt", "time_sk",
                                             "fact_impact_sk"], 5)
    per = MT.regression_metrics(s, "co2_kg", "co2_pred", by=["fold"])
    return MT.mean_std(per, "rmse")


@register("split_stratified", "X3",
          "y_true:i is_test:i n:i",
          with_views(f"""
WITH h AS (SELECT *, {SP.hash_unit_sql("id", 42)} AS u FROM scored),
r AS (SELECT *, row_number() OVER (PARTITION BY y_true ORDER BY u, id) - 1 AS p,
             count(*) OVER (PARTITION BY y_true) AS nc FROM h)
, s AS (SELECT *, CASE WHEN min(nc) OVER () < 2 THEN u < 0.2 ELSE p < round(0.2 * nc) END AS t FROM r)
SELECT y_true, CAST(t AS INTEGER) AS is_test, count(*) AS n FROM s GROUP BY ALL""", "scored"))
def split_stratified(w):
    """Stratified 80/20 split by the cancellation label: per-class counts."""
    s = SP.stratified_split(scored_trips(w.spark, w.sf_dir), "y_true", "id", 0.2, 42)
    return s.groupBy("y_true", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("split_stratified_kfold", "X5",
          "y_true:i fold:i n:i",
          with_views(f"""
WITH h AS (SELECT *, {SP.hash_unit_sql("id", 42)} AS u FROM scored),
f AS (SELECT y_true, (row_number() OVER (PARTITION BY y_true ORDER BY u, id) - 1) % 5 AS fold FROM h)
SELECT y_true, fold, count(*) AS n FROM f GROUP BY ALL""", "scored"))
def split_stratified_kfold(w):
    """Shuffled stratified 5-fold assignment: rows per (class, fold)."""
    s = SP.stratified_kfold(scored_trips(w.spark, w.sf_dir), "y_true", "id", 5)
    return s.groupBy("y_true", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("split_positional", "T4",
          "is_test:i n:i first_pos_month:d",
          with_views("""
WITH o AS (SELECT *, row_number() OVER (ORDER BY annee_mois_dt, zone_sk, mode_sk, time_sk,
                                         fact_impact_sk) - 1 AS pos,
                  count(*) OVER () AS n FROM eco_features)
SELECT CASE WHEN pos >= floor(n * 0.8) THEN 1 ELSE 0 END AS is_test, count(*) AS n,
       min(annee_mois_dt) AS first_pos_month FROM o GROUP BY 1""", "eco_features"))
def split_positional(w):
    """Positional 80/20 split along time (the temporal split's fallback)."""
    f = E.engineer_features(E.clean_territorial(w))
    s = SP.positional_split(f, ["annee_mois_dt", "zone_sk", "mode_sk", "time_sk", "fact_impact_sk"])
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"),
                                    F.min("annee_mois_dt").alias("first_pos_month"))
