"""Ranking curves: ROC, precision-recall, AUC.

The rows are first aggregated per distinct score (partial aggregation; a
score shared by a third of the rows is one row per map task), then the
cumulative positives/negatives along the descending score come from
``running_totals`` (block prefix sums), so even millions of distinct scores
never sit in one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.operators.ordered import running_totals


def score_table(df: DataFrame, y: str, score: str) -> DataFrame:
    """Per distinct score: positives, negatives, and cumulative counts of all
    rows scoring at least that much (ties collapsed, as in sklearn)."""
    per = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"),
        F.sum((F.col(y) != 1).cast("long")).alias("neg"))
    per = per.withColumn("_neg_thr", -F.col("threshold"))   # descending score order
    return running_totals(per, ["_neg_thr"], ["pos", "neg"], prefix="cum_").drop("_neg_thr")


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score."""
    t = score_table(df, y, score)
    tot = t.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))  # the per-score stage, not the rows
    P, N = tot.select("p").scalar(), tot.select("n").scalar()
    return t.select("threshold",
                    F.try_divide(F.col("cum_neg"), N).alias("fpr"),
                    F.try_divide(F.col("cum_pos"), P).alias("tpr"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """M7: exact ROC AUC = P(score_pos > score_neg) + 0.5 P(tie)
    (Mann-Whitney with mid-ranks; equals the trapezoid area of the curve).

    With cum_neg = negatives scoring at least s: negatives strictly below s
    = N - cum_neg, so AUC = (P N - sum(pos cum_neg) + sum(pos neg) / 2) / (P N),
    one aggregate over the per-score table."""
    t = score_table(df, y, score)
    P, N = F.sum("pos"), F.sum("neg")
    num = P * N - F.sum(F.col("pos") * F.col("cum_neg")) + 0.5 * F.sum(F.col("pos") * F.col("neg"))
    return t.agg(F.try_divide(num, P * N).alias("auc"), P.alias("n_pos"), N.alias("n_neg"))


def roc_auc_ovr(df: DataFrame, y: str, scores: dict[int, str]) -> DataFrame:
    """M7: one-vs-rest AUC of each class (class -> its score column) and their
    macro mean; a class without positives or negatives has NULL and is left
    out of the mean."""
    per = None
    for c, score in scores.items():
        one = roc_auc(df.withColumn("_y", (F.col(y) == c).cast("int")), "_y", score).select(
            F.lit(c).alias("class"), "auc")
        per = one if per is None else per.unionByName(one)
    return per.unionByName(per.agg(F.lit(None).cast("int").alias("class"), F.avg("auc").alias("auc")))


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """Precision, recall and F1 at every distinct score used as a
    ``score >= threshold`` cut."""
    t = score_table(df, y, score)
    P = t.agg(F.sum("pos").alias("p")).select("p").scalar()
    prec = F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    rec = F.try_divide(F.col("cum_pos"), P)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return t.select("threshold", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def best_f1_threshold(df: DataFrame, y: str, score: str) -> DataFrame:
    """W11 + M16: the F1-maximising threshold; ties go to the lowest
    threshold (numpy ``argmax`` over ascending thresholds)."""
    c = pr_curve(df, y, score)
    best = c.agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                          F.struct(F.col("f1"), -F.col("threshold"))).alias("b"))
    return best.select("b.threshold", "b.precision", "b.recall", "b.f1")
