"""Y8 augmented Dickey-Fuller per series in
grouped-map tasks, Y9 KPSS in SQL expressions (a series is one row per period,
bounded by the calendar). Statistics follow their published definitions: ADF with AIC lag
selection over ``12 (n/100)^(1/4)`` lags and MacKinnon (2010) response-
surface critical values; KPSS level-stationarity with a Bartlett-weighted
long-run variance and the Hobijn et al. (1998) automatic bandwidth.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.operators.joins import null_safe_join

# MacKinnon (2010) response-surface coefficients, constant-only
# case, one variable: crit(n) = b0 + b1/n + b2/n^2 + b3/n^3 for 1 %, 5 %, 10 %.
MACKINNON_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def _ols(y: np.ndarray, x: np.ndarray):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    n, k = x.shape
    ssr = float(resid @ resid)
    sigma2 = ssr / max(n - k, 1)
    cov = sigma2 * np.linalg.pinv(x.T @ x)
    llf = -n / 2.0 * (np.log(2 * np.pi) + np.log(ssr / n) + 1.0)
    return beta, np.sqrt(np.diag(cov)), llf


def adf(y: np.ndarray) -> tuple[float, int, dict[str, float]]:
    y = np.asarray(y, dtype=float)
    n = len(y)
    maxlag = int(np.ceil(12.0 * (n / 100.0) ** 0.25))
    maxlag = max(0, min(n // 2 - 2, maxlag))
    dy = np.diff(y)

    def design(lag: int, start: int):
        rows = range(start, len(dy))
        yl = np.array([y[t] for t in rows])
        cols = [np.ones(len(yl)), yl]
        for j in range(1, lag + 1):
            cols.append(np.array([dy[t - j] for t in rows]))
        return np.array([dy[t] for t in rows]), np.column_stack(cols)

    best_aic, best_lag = np.inf, 0
    for lag in range(0, maxlag + 1):
        yy, xx = design(lag, maxlag)
        _, _, llf = _ols(yy, xx)
        aic = -2 * llf + 2 * xx.shape[1]
        if aic < best_aic:
            best_aic, best_lag = aic, lag
    yy, xx = design(best_lag, best_lag)
    beta, se, _ = _ols(yy, xx)
    stat = float(beta[1] / se[1]) if se[1] > 0 else float("nan")
    nobs = len(yy)
    crit = {k: b[0] + b[1] / nobs + b[2] / nobs ** 2 + b[3] / nobs ** 3 for k, b in MACKINNON_C.items()}
    return stat, best_lag, crit


def kpss(df: DataFrame, keys: Sequence[str], ds: str, y: str) -> DataFrame:
    """KPSS level-stationarity per series, in window expressions.

    With e the deviations from the mean and n points, the statistic is
    sum(S_t**2) / n**2 over the Bartlett-weighted long-run variance, S_t the
    running sum of e. The bandwidth is the automatic one of Hobijn, Franses and
    Ooms (1998). A series is calendar-bounded, and so is its array.
    """
    keys = list(keys)
    per = Window.partitionBy(*keys)
    x = df.where(F.col(y).isNotNull()).select(*keys, F.col(ds).alias("_ds"), F.col(y).cast("double").alias("_y"))
    run = per.orderBy("_ds")
    x = x.select(*keys, (F.col("_y") - F.avg("_y").over(per)).alias("_e"), F.row_number().over(run).alias("_t"),
                 F.count(F.lit(1)).over(per).alias("_n"))
    total = F.sum("_e").over(per.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0))
    base = x.withColumn("_s", total).groupBy(*keys).agg(
        F.max("_n").alias("n"), F.sum(F.col("_s") * F.col("_s")).alias("_ss"),
        F.array_sort(F.collect_list(F.struct("_t", "_e"))).alias("_p"))
    base = base.withColumn("_e", F.transform("_p", lambda p: p["_e"])).drop("_p")

    def product(lag):
        """Sum of e_t * e_(t - lag)."""
        return F.aggregate(F.sequence(F.lit(0), F.col("n").cast("int") - lag - 1), F.lit(0.0),
                           lambda acc, i: acc + F.get("_e", i) * F.get("_e", i + lag))

    first = F.pow(F.col("n").cast("double"), 2.0 / 9.0).cast("int")
    lags = F.sequence(F.lit(1), F.col("_l0"))
    base = base.withColumn("_l0", F.greatest(F.least(first, F.col("n").cast("int") - 1), F.lit(1))).where("n > 1")
    # both sums weight the first autocovariances: once evenly, once by lag
    base = base.withColumn("_g0", product(F.lit(0)) / F.col("n")).withColumn(
        "_g", F.transform(lags, lambda j: F.struct(j.alias("j"), (product(j) * 2.0 / F.col("n")).alias("v"))))
    even = F.aggregate("_g", F.col("_g0"), lambda acc, g: acc + g["v"])
    by_lag = F.aggregate("_g", F.lit(0.0), lambda acc, g: acc + g["j"] * g["v"])
    ratio = F.coalesce(F.try_divide(by_lag, even), F.lit(0.0))
    wide = F.lit(1.1447) * F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * F.pow(F.col("n").cast("double"), 1.0 / 3.0)
    base = base.withColumn("kpss_lag", F.least(wide.cast("int"), F.col("n").cast("int") - 1))
    taper = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("kpss_lag"), F.lit(1))), F.lit(0.0),
                        lambda acc, j: acc + F.when(j <= F.col("kpss_lag"), product(j) * (
                            F.lit(1.0) - j / (F.col("kpss_lag") + 1.0))).otherwise(0.0))
    variance = F.col("_g0") + taper * 2.0 / F.col("n")
    stat = F.try_divide(F.col("_ss") / (F.col("n") * F.col("n")), variance)
    return base.select(*keys, "n", stat.alias("kpss_stat"), F.col("kpss_lag").cast("long").alias("kpss_lag"),
                       (stat < 0.463).cast("int").alias("kpss_stationary"))


def stationarity_tests(df: DataFrame, keys: Sequence[str], ds: str, y: str, min_points: int = 8) -> DataFrame:
    """Y8 + Y9 per series: ADF statistic, lag, 5 % critical value and verdict;
    KPSS statistic and lag (5 % critical value 0.463 for the level case). A
    series under ``min_points`` points keeps its row, with NULLs and a status."""
    keys = list(keys)
    schema = (", ".join(f"{k} long" for k in keys) +
              ", n long, adf_stat double, adf_lag long, adf_crit_5 double, adf_stationary int, status string")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {k: int(pdf[k].iloc[0]) if pd.notna(pdf[k].iloc[0]) else None for k in keys}
        v = pdf.dropna(subset=[y]).sort_values(ds)[y].to_numpy(dtype=float)
        row["n"] = len(v)
        if len(v) < min_points:
            row.update(adf_stat=None, adf_lag=None, adf_crit_5=None, adf_stationary=None,
                       status=f"too short: fewer than {min_points} points")
        else:
            st, lag, crit = adf(v)
            row.update(adf_stat=st, adf_lag=lag, adf_crit_5=crit["5%"], adf_stationary=int(st < crit["5%"]),
                       status="tested")
        return pd.DataFrame([row])

    series = df.select(*[F.col(k).cast("long").alias(k) for k in keys], ds, F.col(y).cast("double").alias(y))
    unit_root = series.groupBy(*keys).applyInPandas(run, schema)
    level = kpss(series, keys, ds, y).where(F.col("n") >= min_points).drop("n")
    return null_safe_join(unit_root, level, keys, "left")
