"""Estimator / Model pairs for preprocessing (E1, E2, E3, IO11, IO12, P14).

Each is a ``pyspark.ml`` stage with readable and writable state, so imputer,
encoder, standardiser and model are fitted, saved and reloaded as one
``PipelineModel``. Parameters and per-column statistics are saved as params; an
encoder's tables, one row per key, are saved as Parquet and never reach the
driver.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.operators.clean import resolve_features
from citypulse.operators.joins import lookup_with_default
from citypulse.operators.models.common import train_medians


def _outputs(stage: Params) -> list[str]:
    """The output names, by default ``<input><suffix>``."""
    if stage.isDefined(stage.outputCols):
        return stage.getOrDefault(stage.outputCols)
    return [c + stage.suffix for c in stage.getInputCols()]


class _Columns(HasInputCols, HasOutputCols):
    suffix = ""

    def _present(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """Input and output columns whose input exists in ``df``."""
        names = dict(zip(self.getInputCols(), _outputs(self)))
        found = resolve_features(df, self.getInputCols())
        return found, [names[c] for c in found]


class Standardizer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Mean and standard deviation of each column over the fitted rows, in
    one aggregate; ``ddof`` 0 gives the population's, 1 the sample's. Nulls are
    left out of the statistics and stay null."""

    suffix = "_scaled"
    ddof = Param(Params._dummy(), "ddof", "delta degrees of freedom", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, ddof=0):
        super().__init__()
        self._setDefault(ddof=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "StandardizerModel":
        cols, names = self._present(dataset)
        spread = F.stddev_samp if self.getOrDefault(self.ddof) else F.stddev_pop
        row = dataset.agg(*[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(cols)
                            for k, f in (("m", F.avg), ("s", spread))]).first()
        return StandardizerModel()._set(
            inputCols=cols, outputCols=names,
            means=[float(row[f"m{i}"] or 0.0) for i in range(len(cols))],
            deviations=[float(row[f"s{i}"] or 0.0) for i in range(len(cols))])


class StandardizerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted ``Standardizer``; a column without spread scales to 0."""

    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "standard deviation per column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.means),
                    self.getOrDefault(self.deviations))
        return dataset.withColumns({out: (F.col(c).cast("double") - m) / s if s > 0 else
                                    F.when(F.col(c).isNotNull(), F.lit(0.0)) for c, out, m, s in state})


class MedianImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Exact medians of the fitted rows (NaN counts as missing)."""

    suffix = "_filled"

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MedianImputerModel":
        cols, names = self._present(dataset)
        clean = dataset.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in cols])
        medians = train_medians(clean, cols)
        return MedianImputerModel()._set(inputCols=cols, outputCols=names, medians=[medians[c] for c in cols])


class MedianImputerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted ``MedianImputer``; a column that had no value is filled with 0."""

    medians = Param(Params._dummy(), "medians", "median per column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.medians))
        return dataset.withColumns({out: F.coalesce(F.nullif(F.col(c).cast("double"), F.lit(float("nan"))), F.lit(m))
                                    for c, out, m in state})


class _Encodings(HasLabelCol):
    encodings = Param(Params._dummy(), "encodings", "output column -> list of key columns")

    def _keys(self) -> dict[str, list[str]]:
        return self.getOrDefault(self.encodings)


class MeanEncoder(Estimator, _Encodings, DefaultParamsReadable, DefaultParamsWritable):
    """Mean of the label per key, over the fitted rows only (G5), for single
    or composite keys, and over all of them for keys that are new or null."""

    @keyword_only
    def __init__(self, *, encodings=None, labelCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MeanEncoderModel":
        label = self.getLabelCol()
        overall = dataset.agg(F.avg(label).alias("m")).first()["m"]
        model = MeanEncoderModel()._set(encodings=self._keys(), labelCol=label, overall=float(overall or 0.0))
        model.tables = {out: dataset.groupBy(*keys).agg(F.avg(label).alias(out)) for out, keys in self._keys().items()}
        return model


class MeanEncoderModel(Model, _Encodings, MLReadable, MLWritable):
    """Fitted ``MeanEncoder``: one table of one row per key for each output."""

    overall = Param(Params._dummy(), "overall", "label mean of the fitted rows", TypeConverters.toFloat)
    tables: dict[str, DataFrame]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        default = F.lit(self.getOrDefault(self.overall))
        for out, keys in self._keys().items():
            dataset = lookup_with_default(dataset, self.tables[out], keys, out, default)
        return dataset

    def copy(self, extra=None):
        other = super().copy(extra)
        other.tables = self.tables
        return other

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, instance: MeanEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        # numbered, so any output name makes a valid folder
        for i, out in enumerate(self.instance._keys()):
            self.instance.tables[out].write.parquet(f"{path}/tables/{i}")


class _EncoderReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> MeanEncoderModel:
        spark: SparkSession = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.tables = {out: spark.read.parquet(f"{path}/tables/{i}") for i, out in enumerate(model._keys())}
        return model
