"""Model-quality metrics as aggregates.

Each metric is one pass of built-in aggregates, grouped when asked (M2);
means are taken through sums so partial aggregation applies. Global
statistics needed inside another expression (the mean of y for R²) are
scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """M1/M2: RMSE, MAE, R² (R² = 1 - SSE / SST) and n, optionally per group."""
    by = list(by)
    e = F.col(y) - F.col(pred)
    base = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    agg = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"),
        # SST = n * population variance (Spark's stable central-moment update)
        (F.count(F.lit(1)) * F.var_pop(y)).alias("_sst"))
    return (agg.withColumn("r2", F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")))
               .drop("_sse", "_sst"))


def mape(df: DataFrame, y: str, pred: str, positive_only: bool = True,
         by: Sequence[str] = ()) -> DataFrame:
    """M4: mean absolute percentage error; ``positive_only`` keeps actuals > 0
    (the scripts), otherwise only zero actuals are skipped (the notebook's
    sklearn call would divide by a tiny epsilon there)."""
    cond = F.col(y) > 0 if positive_only else F.col(y) != 0
    return (df.where(cond & F.col(pred).isNotNull()).groupBy(*by)
              .agg(F.avg(F.abs((F.col(y) - F.col(pred)) / F.col(y))).alias("mape")))


def confusion_counts(df: DataFrame, y: str, pred: str, labels: Sequence[int]) -> DataFrame:
    """M8: (actual, predicted, count) over the full label grid, zeros kept.
    The grid is labels x labels (a literal), the counts one aggregate."""
    counts = df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.createDataFrame(
        [(int(a), int(p)) for a in labels for p in labels], "actual int, predicted int")
    return (grid.join(counts, on=["actual", "predicted"], how="left")
                .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def binary_scores(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """M5 (+accuracy): precision, recall, F1 of class 1 with zero-division -> 0."""
    tp = F.sum(((F.col(y) == 1) & (F.col(pred) == 1)).cast("long"))
    fp = F.sum(((F.col(y) != 1) & (F.col(pred) == 1)).cast("long"))
    fn = F.sum(((F.col(y) == 1) & (F.col(pred) != 1)).cast("long"))
    agg = df.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                              F.count(F.lit(1)).alias("n"),
                              F.sum((F.col(y) == F.col(pred)).cast("long")).alias("_ok"))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                    F.lit(0.0))
    return agg.select(*by, "tp", "fp", "fn", "n", p.alias("precision"), r.alias("recall"),
                      f1.alias("f1"), (F.col("_ok") / F.col("n")).alias("accuracy"))


def per_class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """M6: one-vs-rest precision / recall / F1 / support per class present in
    the truth or the predictions."""
    classes = (df.select(F.col(y).alias("cls")).union(df.select(F.col(pred).alias("cls")))
                 .distinct())
    per_true = df.groupBy(F.col(y).alias("cls")).agg(
        F.count(F.lit(1)).alias("support"),
        F.sum((F.col(pred) == F.col(y)).cast("long")).alias("tp"))
    per_pred = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    r = (classes.join(per_true, "cls", "left").join(per_pred, "cls", "left")
                .fillna(0, ["support", "tp", "n_pred"]))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("n_pred") + F.col("support")), F.lit(0.0))
    return r.select(F.col("cls").alias("class"), "support", prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"))


def f1_summary(df: DataFrame, y: str, pred: str) -> DataFrame:
    """M6: accuracy, macro F1 and support-weighted F1."""
    rep = per_class_report(df, y, pred)
    acc = df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("a")).select("a").scalar()
    return rep.agg(
        acc.alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.sum("support").alias("n"))


def threshold_predictions(df: DataFrame, score: str, threshold, out: str = "y_pred") -> DataFrame:
    """Hard class at a threshold (number or Column, e.g. the best-F1 one)."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    return df.withColumn(out, (F.col(score) >= t).cast("int"))


def residuals(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Residual table (actual - predicted)."""
    return df.withColumn("residual", F.col(y) - F.col(pred))


def mean_std(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of fold scores (numpy ``std``)."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                               F.count(F.lit(1)).alias("n"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several single-row report frames side by side.

    Each frame becomes one struct-valued scalar subquery (evaluated once,
    reused for every field), so no join is involved."""
    spark = frames[0].sparkSession
    cols = []
    for d in frames:
        s = d.select(F.struct(*[F.col(c) for c in d.columns]).alias("s")).select("s").scalar()
        cols += [s.getField(c).alias(c) for c in d.columns]
    return spark.range(1).select(*cols)
