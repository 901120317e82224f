"""Projection, filter and cleaning operators.

Column checks (P1-P4, E3) only read ``df.columns``: driver metadata, no job.
Everything else is a built-in expression that stays inside whole-stage
codegen. Spark 4 runs ANSI mode, so coercions use ``try_cast`` and ratios
``try_divide`` (pandas gives NaN where ANSI would raise).
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("citypulse")


# -- P1-P4: schema-level helpers --------------------------------------------

def drop_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring those that are absent."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Drop every column whose name starts with ``prefix`` (``bak_``)."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def select_existing(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Keep-list projection of the columns that exist, in keep-list order."""
    return df.select(*[c for c in keep if c in df.columns])


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> None:
    """Raise when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what}: required column(s) missing: {missing}")


def resolve_features(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Ordered, de-duplicated list of the wanted columns that exist;
    missing ones are logged, not fatal."""
    seen: list[str] = []
    for c in wanted:
        if c not in seen:
            seen.append(c)
    avail = [c for c in seen if c in df.columns]
    missing = [c for c in seen if c not in df.columns]
    if missing:
        log.warning("features not available, skipped: %s", missing)
    return avail


# -- P5-P11: row filters and value cleaning ----------------------------------

def valid_zone_filter(df: DataFrame, max_zone: int = 10, strict_names: bool = True) -> DataFrame:
    """Keep zones 1..max_zone with a real (non-UNKNOWN) name.

    ``strict_names=False`` is the safety loader's simple ``zone_sk <= max``.
    """
    if not strict_names:
        return df.where(F.col("zone_sk") <= max_zone)
    return df.where(
        F.col("zone_sk").between(1, max_zone)
        & F.col("zone_nom").isNotNull()
        & (F.upper(F.trim(F.col("zone_nom"))) != F.lit("UNKNOWN")))


def nan_to_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def coerce_numeric(df: DataFrame, cols: Iterable[str], dtype: str = "double",
                   fill: float | None = None) -> DataFrame:
    """Text or numbers -> ``dtype``; unparsable -> NULL (NaN -> NULL too).
    ``fill`` replaces the resulting NULLs (P11, the safety loader's ``fillna(0)``)."""
    out = df
    for c in cols:
        if c not in out.columns:
            continue
        v = (F.col(c).cast("string")).try_cast(dtype) if not isinstance(
            out.schema[c].dataType, T.NumericType) else F.col(c).cast(dtype)
        if dtype in ("double", "float"):
            v = nan_to_null(v)
        if fill is not None:
            v = F.coalesce(v, F.lit(fill).cast(dtype))
        out = out.withColumn(c, v)
    return out


def zero_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Sentinel 0 -> missing."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.nullif(F.col(c), F.lit(0).cast(out.schema[c].dataType)))
    return out


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """P10: drop rows with a NULL (or NaN) in any column of ``subset``."""
    return df.dropna(subset=list(subset))


def clip(c: str | Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Clip to bounds, keeping missing values missing (trap S18:
    ``greatest``/``least`` would turn NULL into the bound)."""
    c = F.col(c) if isinstance(c, str) else c
    v = c
    if lower is not None:
        v = F.when(v < F.lit(lower), F.lit(lower)).otherwise(v)
    if upper is not None:
        v = F.when(v > F.lit(upper), F.lit(upper)).otherwise(v)
    return F.when(c.isNotNull(), v)


def safe_ratio(num: str | Column, den: str | Column, positive_only: bool = True) -> Column:
    """P20: guarded ratio; NULL where the denominator is 0 (or not > 0)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    guard = den > 0 if positive_only else den != 0
    return F.when(guard, F.try_divide(num, den))


def smoothed_ratio(num: str | Column, den: str | Column) -> Column:
    """P20: ``num / (den + 1)`` (gravite_index)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return num / (den + F.lit(1)).cast("double")


def threshold_band(c: str | Column, low: float = 0.20, medium: float = 0.50,
                   labels: Sequence[str] = ("Low", "Medium", "High")) -> Column:
    """Low < low <= Medium < medium <= High."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c < low, labels[0]).when(c < medium, labels[1])
            .when(c.isNotNull(), labels[2]))


def map_values(c: str | Column, mapping: Mapping[object, object], default=None) -> Column:
    """Code -> label map as a literal map lookup (no join)."""
    c = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    v = m[c]
    return F.coalesce(v, F.lit(default)) if default is not None else v


def audit_columns(df: DataFrame, run_ts: str, prediction_type: str | None = None) -> DataFrame:
    """Audit columns; the run timestamp is passed in so reruns are identical."""
    out = df.withColumn("generated_at", F.lit(run_ts))
    if prediction_type is not None:
        out = out.withColumn("prediction_type", F.lit(prediction_type))
    return out


# -- P24/P25: data-quality profile --------------------------------------------

def quality_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One wide aggregate (a single pass), unpivoted to
    (column, n_rows, n_null, n_zero, min, max, mean); the exact medians are
    joined from one counted stage of all columns.
    """
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.sum(F.when(F.col(c).isNull() | F.isnan(x), 1).otherwise(0)).alias(f"{c}__null"),
            F.sum(F.when(x == 0, 1).otherwise(0)).alias(f"{c}__zero"),
            F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
        ]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.col(f"{c}__null").cast("long").alias("n_null"),
                 F.col(f"{c}__zero").cast("long").alias("n_zero"),
                 F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value"),
                 F.col(f"{c}__mean").alias("mean_value"))
        for c in cols])
    from citypulse.operators.ordered import exact_quantiles
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                for c in cols])).alias("x")
    medians = exact_quantiles(df.select(pairs).select("x.column", "x.value"), "value", {"median_value": 0.5},
                              by=["column"])
    return (wide.select(F.col("__n").cast("long").alias("n_rows"), F.explode(rows).alias("r"))
                .select("r.column", "n_rows", "r.n_null", "r.n_zero",
                        "r.min_value", "r.max_value", "r.mean_value")
                .join(medians, "column", "left"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P25: pandas-style ``describe()``, one row per (measure, statistic):
    count, mean, std, min, exact quartiles, max. The quartiles come from one
    counted (measure, value) stage for all measures."""
    from citypulse.operators.joins import null_safe_join
    from citypulse.operators.ordered import exact_quantiles
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                                for c in cols])).alias("x")
    long = df.select(pairs).select("x.measure", "x.value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    basic = long.groupBy("measure").agg(
        F.count(F.lit(1)).cast("double").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(long, "value", {"25%": 0.25, "50%": 0.5, "75%": 0.75}, by=["measure"])
    wide = null_safe_join(basic, quartiles, ["measure"])
    stats = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    return wide.select("measure", F.explode(F.array(*[
        F.struct(F.lit(c).alias("statistic"), F.col(f"`{c}`").alias("value")) for c in stats])).alias("s")).select(
        "measure", "s.statistic", "s.value")
