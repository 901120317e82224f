"""Classical additive decomposition (moving-average trend,
centred seasonal means, residual), per series.

Series are one row per period (month / day) per key, so every window
partition is bounded by the calendar. Matches the classical definition:
trend is the centred moving average of length ``period`` (for an even
period the two end points weigh one half), missing where the window is
incomplete; the seasonal component is the mean of the detrended values at
each phase ``position % period``, centred to sum to zero; the residual is
what remains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def classical_decompose(df: DataFrame, by: Sequence[str], order: str, value: str,
                        period: int) -> DataFrame:
    by = list(by)
    w = Window.partitionBy(*by).orderBy(order)
    half = period // 2
    x = F.col(value)
    pos = F.row_number().over(w) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    out = df.withColumn("_pos", pos).withColumn("_n", n)
    full = (F.col("_pos") >= half) & (F.col("_pos") < F.col("_n") - half)
    if period % 2 == 0:
        s = F.sum(x).over(w.rowsBetween(-half, half))
        trend = (s - 0.5 * F.lag(x, half).over(w) - 0.5 * F.lead(x, half).over(w)) / period
    else:
        trend = F.sum(x).over(w.rowsBetween(-half, half)) / period
    out = out.withColumn("trend", F.when(full, trend)).withColumn("_detr", x - F.col("trend"))
    out = out.withColumn("_phase", F.pmod("_pos", F.lit(period)))
    phase = out.groupBy(*by, "_phase").agg(F.avg("_detr").alias("_pa"))
    phase = phase.withColumn("seasonal", F.col("_pa") - F.avg("_pa").over(Window.partitionBy(*by)))
    return (out.join(phase.select(*by, "_phase", "seasonal"), on=[*by, "_phase"])
               .withColumn("resid", F.col("_detr") - F.col("seasonal"))
               .drop("_pos", "_n", "_detr", "_phase"))
