"""Multiplicative seasonal ARIMA (1,1,1)(1,0,0,s) per series.

The differenced series z follows ``(1 - ar B)(1 - sar B^s) z = (1 + ma B) e``, so
the coefficient at lag s + 1 is the product of those at 1 and s. The three
parameters minimise the conditional sum of squares of e by damped Gauss-Newton
steps from several starts, inside the stationary and invertible region. A series
is one row per period, so a group is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 0.995  # bound of each parameter
MIN_RESIDUALS = 6  # two per parameter
STARTS = [(0.0, 0.0, 0.0), (0.5, 0.5, 0.5), (0.5, -0.5, 0.5), (-0.5, 0.5, 0.5), (-0.5, -0.5, -0.5), (0.1, 0.1, 0.9)]
PARAMETERS = ["ar", "ma", "seasonal_ar"]
SHORT = "too short for the seasonal lags"


def residuals(z: np.ndarray, params: np.ndarray, season: int) -> tuple[np.ndarray, np.ndarray]:
    """(e, gradient of e by (ar, ma, sar)) from position season + 1 on; the
    residual before it is taken as 0."""
    ar, ma, sar = params
    at = np.arange(season + 1, len(z))
    lag1, lag_s, both = z[at - 1], z[at - season], z[at - season - 1]
    drive = np.column_stack([z[at] - ar * lag1 - sar * lag_s + ar * sar * both,
                             -(lag1 - sar * both), np.zeros(len(at)), -(lag_s - ar * both)])
    out = np.empty_like(drive)
    last = np.zeros(4)
    for i, row in enumerate(drive):
        now = row - ma * last
        now[2] -= last[0]
        out[i] = last = now
    return out[:, 0], out[:, 1:]


def fit(z: np.ndarray, season: int, steps: int = 60) -> np.ndarray:
    """(ar, ma, sar) of the least conditional sum of squares over all starts."""
    best, best_cost = np.zeros(3), np.inf
    for start in STARTS:
        params = np.array(start)
        e, grad = residuals(z, params, season)
        cost, damping = float(e @ e), 1e-3
        for _ in range(steps):
            curve = grad.T @ grad
            scale = np.diag(np.maximum(np.diag(curve), 1e-12))
            move = np.linalg.solve(curve + damping * scale, -(grad.T @ e))
            trial = np.clip(params + move, -LIMIT, LIMIT)
            e2, grad2 = residuals(z, trial, season)
            cost2 = float(e2 @ e2)
            if cost2 < cost:
                done = cost - cost2 <= 1e-10 * cost
                params, e, grad, cost = trial, e2, grad2, cost2
                damping = max(damping / 4, 1e-9)
                if done:
                    break
            else:
                damping *= 8
                if damping > 1e8:
                    break
        if cost < best_cost:
            best, best_cost = params, cost
    return best


def forecast(v: np.ndarray, steps: int, season: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(forecast, parameters), or None where the series is too short."""
    z = np.diff(v)
    if len(z) - season - 1 < MIN_RESIDUALS:
        return None
    params = fit(z, season)
    ar, ma, sar = params
    last = float(residuals(z, params, season)[0][-1])
    known = list(z)
    for _ in range(steps):
        t = len(known)
        known.append(ar * known[t - 1] + sar * known[t - season] - ar * sar * known[t - season - 1] + ma * last)
        last = 0.0
    return v[-1] + np.cumsum(known[len(z):]), params


def seasonal_arima_forecast(df: DataFrame, keys: Sequence[str], ds: str, y: str, steps: int = 3,
                            season: int = 12, holdout: int = 3) -> DataFrame:
    """One row per key and step: the forecast from the full history, its
    parameters, and MAE and MAPE on the last ``holdout`` points, fitted without
    them. Periods without a value are left out; a series that is too short for
    the seasonal lags gives one row with NULLs and its status."""
    keys = list(keys)
    schema = (", ".join(f"{k} long" for k in keys) + ", step long, forecast double, holdout_mae double, "
              "holdout_mape double, " + ", ".join(f"{p} double" for p in PARAMETERS) + ", status string")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.dropna(subset=[y]).sort_values(ds)[y].to_numpy(dtype=float)
        found = forecast(v, steps, season)
        back = forecast(v[:-holdout], holdout, season) if len(v) > holdout else None
        mae = mape = None
        if back is not None:
            true = v[-holdout:]
            gap, on = np.abs(back[0] - true), true > 0
            mae = float(gap.mean())
            mape = float((gap[on] / true[on]).mean() * 100) if on.any() else None
        if found is None:  # the series stays in the output, without a forecast
            res = pd.DataFrame({"step": [None], "forecast": [None]})
            res[PARAMETERS] = None
            res["status"] = SHORT
        else:
            res = pd.DataFrame({"step": np.arange(1, steps + 1), "forecast": found[0]})
            for name, value in zip(PARAMETERS, found[1]):
                res[name] = value
            res["status"] = "fitted" if mae is not None else "fitted; too short to hold out"
        res["holdout_mae"], res["holdout_mape"] = mae, mape
        for k in keys:
            res[k] = int(pdf[k].iloc[0]) if pd.notna(pdf[k].iloc[0]) else None
        return res

    series = df.select(*[F.col(k).cast("long").alias(k) for k in keys], ds, F.col(y).cast("double").alias(y))
    return series.groupBy(*keys).applyInPandas(run, schema)
