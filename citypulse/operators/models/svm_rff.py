"""RBF-kernel SVM, re-aimed for scale.

A kernel SVM solves an n x n problem on one machine. Random Fourier
features (Rahimi & Recht 2007) approximate the RBF kernel
exp(-gamma |x - x'|^2) with ``D`` features ``sqrt(2/D) cos(w.x + b)``,
``w ~ N(0, 2 gamma I)``, ``b ~ U(0, 2 pi)``; they are plain column
expressions (codegen, no Python), and a linear SVM (MLlib ``LinearSVC``,
class-balanced weights) is fitted on them. Probabilities come from a
one-dimensional logistic regression on the margin (Platt scaling).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rff_columns(cols: Sequence[str], n_features: int = 64, gamma: float | None = None,
                seed: int = 42) -> list:
    """``n_features`` random Fourier feature expressions of ``cols``
    (standardised inputs; ``gamma`` defaults to 1 / n_cols, sklearn's
    'scale' on unit-variance data)."""
    d = len(cols)
    g = gamma if gamma is not None else 1.0 / d
    rng = np.random.RandomState(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * g), size=(n_features, d))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_features)
    amp = math.sqrt(2.0 / n_features)
    exprs = []
    for j in range(n_features):
        lin = sum((F.col(c) * float(w[j, i]) for i, c in enumerate(cols)), F.lit(float(b[j])))
        exprs.append((F.cos(lin) * amp).alias(f"rff_{j}"))
    return exprs


class RFFSVM:
    def __init__(self, cols: Sequence[str], label: str, weight_col: str | None = None,
                 n_features: int = 64, reg: float = 0.01, seed: int = 42):
        self.cols, self.label, self.weight_col = list(cols), label, weight_col
        self.n_features, self.reg, self.seed = n_features, reg, seed

    def _expand(self, df: DataFrame) -> DataFrame:
        feats = rff_columns(self.cols, self.n_features, seed=self.seed)
        x = df.select("*", *feats)
        return VectorAssembler(inputCols=[f"rff_{j}" for j in range(self.n_features)],
                               outputCol="rff").transform(x).drop(
            *[f"rff_{j}" for j in range(self.n_features)])

    def fit(self, train: DataFrame) -> "RFFSVM":
        x = self._expand(train)
        svc = LinearSVC(featuresCol="rff", labelCol=self.label, regParam=self.reg, maxIter=100)
        if self.weight_col:
            svc = svc.setWeightCol(self.weight_col)
        self.svm = svc.fit(x)
        margin = self._margin(self.svm.transform(x)).drop("prediction", "rawPrediction")
        self.platt = LogisticRegression(featuresCol="m", labelCol=self.label, maxIter=50).fit(
            VectorAssembler(inputCols=["margin"], outputCol="m").transform(margin))
        return self

    @staticmethod
    def _margin(df: DataFrame) -> DataFrame:
        return df.withColumn("margin", vector_to_array("rawPrediction")[1])

    def transform(self, df: DataFrame) -> DataFrame:
        x = self._margin(self.svm.transform(self._expand(df)))
        p = self.platt.transform(VectorAssembler(inputCols=["margin"], outputCol="m").transform(
            x.drop("rawPrediction", "probability").withColumnRenamed("prediction", "svm_pred")))
        return (p.withColumn("proba", vector_to_array("probability")[1])
                 .drop("rff", "m", "rawPrediction", "probability", "prediction"))
