"""Shared model plumbing: feature assembly, train-fit imputation,
importances, scoring helpers (L14, L16, T5, P14, S14)."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.operators.ordered import exact_quantiles

ROWS_PER_PARTITION = 50_000


def train_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians of the training rows, one pass for all columns (one
    number per column comes back). A column without values gets 0."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                                for c in cols])).alias("x")
    found = exact_quantiles(train.select(pairs).select("x.name", "x.value"), "value", {"m": 0.5}, by=["name"])
    return dict.fromkeys(cols, 0.0) | {r["name"]: float(r["m"]) for r in found.collect()}


def feature_pipeline(train: DataFrame, cols: Sequence[str], out: str = "features") -> list:
    """Median imputation fitted on the training rows (MLlib trees reject
    missing values, XGBoost routes them - trap S14) followed by assembly.
    The medians and the feature list travel inside the fitted ``PipelineModel``."""
    cols = list(cols)
    medians = train_medians(train, cols)
    filled = ", ".join(f"coalesce(nullif(CAST(`{c}` AS DOUBLE), double('NaN')), {medians[c]!r}D) AS `{c}__imp`"
                       for c in cols)
    return [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
            VectorAssembler(inputCols=[f"{c}__imp" for c in cols], outputCol=out, handleInvalid="keep")]


def as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


def fit(estimator, train: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """Fit imputer + assembler + estimator on the features that exist
    (E3/U3: ordered, de-duplicated, missing ones logged and skipped). The
    assembled training vectors are cached for the fit and released after it."""
    from citypulse.operators.clean import resolve_features
    cols = resolve_features(train, cols)
    stages = feature_pipeline(train, cols)
    with assembled(train, stages, estimator) as data:
        return PipelineModel(stages=[*stages, estimator.fit(data)])


@contextmanager
def assembled(df: DataFrame, stages: list, estimator, extra: Sequence[str] = ()):
    """The columns a fit reads, assembled once and cached in as few partitions
    as their rows need: a boosting round is several short jobs over them."""
    for t in stages:
        df = t.transform(df)
    params = [estimator.getOrDefault(p) for p in ("labelCol", "weightCol", "validationIndicatorCol")
              if estimator.hasParam(p) and estimator.isDefined(p)]
    wanted = [c for c in dict.fromkeys(["features", *params, *extra]) if c in df.columns]
    data = df.select(*wanted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = max(1, -(-data.count() // ROWS_PER_PARTITION))
        fewer = data.coalesce(parts) if parts < data.rdd.getNumPartitions() else data
        yield fewer
    finally:
        data.unpersist()


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "proba") -> DataFrame:
    """Probability of the last class as a plain column."""
    arr = vector_to_array(F.col(prob_col))
    return df.withColumn(out, F.element_at(arr, F.size(arr)))


def importances(model: PipelineModel, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """Impurity importances sorted descending, named by the features that
    the model was fitted on; a wanted feature that was absent then has 0."""
    from pyspark.sql import SparkSession
    vals = model.stages[-1].featureImportances.toArray().tolist()
    fitted = [c.removesuffix("__imp") for c in model.stages[-2].getInputCols()]
    of = dict.fromkeys(cols, 0.0) | dict(zip(fitted, vals))
    sess = SparkSession.getActiveSession()
    df = sess.createDataFrame([(c, float(v)) for c, v in of.items()], "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), "feature")
    return df.limit(top) if top else df


def save(model: PipelineModel, path: str) -> None:
    """IO11: persist the fitted pipeline (features + estimator)."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
