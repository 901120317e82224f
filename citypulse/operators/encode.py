"""Feature encoders.

Statistics are computed by aggregates (partial aggregation, no group in one
task) and attached by joins to tables of one row per key, or by scalar
subqueries for global statistics. A window over the fact
(``avg().over(partitionBy(mode))``) would put each mode - a third of the
table - in one task, so it is never used for these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.operators.joins import lookup_with_default


def dense_codes(df: DataFrame, col: str, out: str | None = None, bounded: bool = False) -> DataFrame:
    """Pandas ``astype('category').cat.codes``: rank of the value among the
    sorted distinct values, from 0; missing -> -1.

    The rank runs over the distinct key set, never over the fact, and the code
    table is joined back (AQE broadcasts it from its measured size). Only a
    dimension that is ``bounded`` (zones, modes) is ranked by one window;
    any other key set is numbered by block prefix sums.
    """
    out = out or f"{col}_encoded"
    keys = df.select(col).where(F.col(col).isNotNull()).distinct()
    if bounded:
        codes = keys.select(col, (F.dense_rank().over(Window.orderBy(col)) - 1).cast("int").alias(out))
    else:
        from citypulse.operators.ordered import ordered_index
        codes = ordered_index(keys, [col], name=out).withColumn(out, F.col(out).cast("int"))
    return (df.join(codes, on=col, how="left")
              .withColumn(out, F.coalesce(F.col(out), F.lit(-1))))


def group_mean_column(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Pandas ``groupby(by)[value].transform('mean')`` as aggregate + join."""
    means = df.groupBy(*by).agg(F.avg(value).alias(out))
    return df.join(means, on=list(by), how="left")


def pop_standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled",
                    ddof: int = 0) -> DataFrame:
    """Sklearn ``StandardScaler`` (population std, trap S3); a zero std
    scales to 0 like sklearn. ``ddof=1`` gives the sample-std variant."""
    stats = df.agg(F.struct(
        *[F.avg(c).alias(f"m_{c}") for c in cols],
        *[(F.stddev_pop(c) if ddof == 0 else F.stddev_samp(c)).alias(f"s_{c}") for c in cols]
    ).alias("st"))
    st = stats.select("st").scalar()   # one subquery, reused for every column
    out = df
    for c in cols:
        m, s = st.getField(f"m_{c}"), st.getField(f"s_{c}")
        out = out.withColumn(f"{c}{suffix}",
                             F.when(s > 0, (F.col(c) - m) / s).otherwise(F.lit(0.0)))
    return out


class TargetEncoder:
    """Leakage-free mean target encoding.

    ``fit`` learns per-key means of ``target`` on the training rows only
    (G5), for single or composite keys, plus the global training mean;
    ``transform`` applies them anywhere with the global mean as default
    (J4/J5). Encoding tables have one row per key.
    """

    def __init__(self, encodings: dict[str, Sequence[str]], target: str):
        self.encodings = {k: list(v) for k, v in encodings.items()}
        self.target = target
        self.tables: dict[str, DataFrame] = {}
        self.global_mean: Column | None = None

    def fit(self, train: DataFrame) -> "TargetEncoder":
        for out, keys in self.encodings.items():
            self.tables[out] = train.groupBy(*keys).agg(F.avg(self.target).alias(out))
        self.global_mean = train.agg(F.avg(self.target).alias("g")).select("g").scalar()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name, keys in self.encodings.items():
            out = lookup_with_default(out, self.tables[name], keys, name, self.global_mean)
        return out

    def save(self, path: str) -> None:
        """IO12: encoding maps as parquet lookup tables, with the global mean."""
        spark = next(iter(self.tables.values())).sparkSession
        for name, t in self.tables.items():
            t.write.mode("overwrite").parquet(f"{path}/{name}")
        spark.range(1).select(self.global_mean.alias("global_mean")).write.mode("overwrite").parquet(
            f"{path}/_global_mean")

    @classmethod
    def load(cls, spark, path: str, encodings: dict[str, Sequence[str]], target: str) -> "TargetEncoder":
        """IO12: the saved maps, ready to ``transform``."""
        enc = cls(encodings, target)
        enc.tables = {name: spark.read.parquet(f"{path}/{name}") for name in enc.encodings}
        enc.global_mean = spark.read.parquet(f"{path}/_global_mean").select("global_mean").scalar()
        return enc
