"""Additive trend + seasonality forecaster, per series.

The model form follows Taylor & Letham (2018): piecewise-linear trend with
hinge changepoints placed over the first 80 % of the history under a sparse
(Laplace) prior of width ``scale``, Fourier terms for yearly (and weekly)
seasonality, optional holiday indicators, y scaled by its absolute maximum, and
intervals from simulated changes to come. The mode is found by reweighted
least squares; the sampler of the reference is not reproduced, so results are
comparable by holdout error, not coefficient by coefficient.

Series are independent: ``groupBy(series).applyInPandas`` fits every
series (and every candidate scale, Y3) in parallel, one task per series.
A series is one row per period (month / day), so a group is bounded by the
calendar, never by the fact table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIOR_TREND, PRIOR_SEASON = 5.0, 10.0  # widths of the normal priors, in units of the scaled series
Z80 = 1.2815515655446004  # two-sided 80 % normal quantile (default interval width)


def _design(t_days: np.ndarray, t0: float, span: float, cps: np.ndarray, yearly: int,
            weekly: int, hol: np.ndarray | None) -> np.ndarray:
    t = (t_days - t0) / span
    cols = [np.ones_like(t), t]
    cols += [np.maximum(0.0, t - c) for c in cps]
    for k in range(1, yearly + 1):
        a = 2 * np.pi * k * t_days / 365.25
        cols += [np.sin(a), np.cos(a)]
    for k in range(1, weekly + 1):
        a = 2 * np.pi * k * t_days / 7.0
        cols += [np.sin(a), np.cos(a)]
    if hol is not None:
        cols += list(hol.T.astype(float))  # one indicator per holiday name
    return np.column_stack(cols)


def _fit(t_days, y, scale, yearly, weekly, hol, n_cp=25, rounds=40):
    """Posterior mode: Laplace prior of width ``scale`` on the slope changes,
    normal priors of their own on seasonal and holiday terms, noise estimated
    along. The Laplace term is met by reweighting: a change near zero is
    penalised ever harder, so most changes vanish and few stay. A seasonality
    of which the history holds less than two periods is left out."""
    t0, span = float(t_days.min()), float(max(t_days.max() - t_days.min(), 1.0))
    yearly = yearly if span >= 2 * 365.25 - 31 else 0
    weekly = weekly if span >= 13 else 0
    m = len(y)
    k = int(min(n_cp, max(0, int(np.floor(0.8 * m)) - 1)))
    hist = t_days[: max(1, int(np.ceil(0.8 * m)))]
    cps = ((np.quantile(hist, np.linspace(0, 1, k + 2)[1:-1]) - t0) / span) if k > 0 else np.array([])
    x = _design(t_days, t0, span, cps, yearly, weekly, hol)
    ys = float(np.max(np.abs(y))) or 1.0
    z = y / ys
    change = slice(2, 2 + len(cps))
    prior = np.full(x.shape[1], 1.0 / PRIOR_TREND ** 2)
    prior[2 + len(cps):] = 1.0 / PRIOR_SEASON ** 2
    width = np.full(len(cps), max(scale, 1e-6))
    variance = max(float(np.var(z)), 1e-8)
    xx, xz = x.T @ x, x.T @ z
    for _ in range(rounds):
        prior[change] = 1.0 / (max(scale, 1e-6) * np.maximum(width, 1e-6))
        beta = np.linalg.solve(xx + variance * np.diag(prior) + 1e-10 * np.eye(len(xx)), xz)
        width = np.abs(beta[change])
        variance = max(float(np.mean((z - x @ beta) ** 2)), 1e-8)
    sigma = float(np.sqrt(variance) * ys) if m > 1 else 0.0
    return (t0, span, cps, beta, ys, sigma, yearly, weekly, (xx, xz, float(z @ z), m, prior))


def _spread(state) -> tuple[float, np.ndarray]:
    """(mean size of a slope change, covariance of the coefficients) given the
    history: the sparse mode shrinks changes, so their size is estimated by
    expectation maximisation over all of them."""
    k, (xx, xz, zz, m, prior) = len(state[2]), state[8]
    change = slice(2, 2 + k)
    prior, width, variance = prior.copy(), 0.1, max((state[5] / state[4]) ** 2, 1e-8)
    for _ in range(60):
        prior[change] = 1.0 / width
        cov = np.linalg.inv(xx / variance + np.diag(prior))
        mean = cov @ xz / variance
        width = max(float(np.mean(mean[change] ** 2 + np.diag(cov)[change])), 1e-10) if k else width
        left = zz - 2 * mean @ xz + mean @ xx @ mean + float((xx * cov).sum())
        variance = max(left / m, 1e-8)
    return float(np.sqrt(width / 2)), (cov + cov.T) / 2


def _predict(state, t_days, hol, last=None, draws=500):
    """(value, lower, upper): the 80 % interval holds the noise and, after the
    ``last`` day of the history, the coefficients' uncertainty and slope changes
    to come, drawn at the rate and with the mean size of those in the history,
    so it widens with the horizon."""
    t0, span, cps, beta, ys, sigma, yearly, weekly = state[:8]
    x = _design(t_days, t0, span, cps, yearly, weekly, hol)
    yhat = x @ beta * ys
    lo, hi = yhat - Z80 * sigma, yhat + Z80 * sigma
    future = np.flatnonzero(t_days > last) if last is not None else []
    if len(future):
        rng = np.random.default_rng(7)  # fixed: the same series has the same interval
        t = (t_days[future] - t0) / span
        steps = np.diff(t, prepend=(last - t0) / span)
        size, cov = _spread(state)
        n = rng.poisson(len(cps) / 0.8 * steps, (draws, len(t)))
        # the sum of n Laplace draws is a difference of two gamma draws
        turn = (rng.gamma(np.maximum(n, 1e-9)) - rng.gamma(np.maximum(n, 1e-9))) * size * (n > 0)
        drift = np.cumsum(np.cumsum(turn, axis=1) * steps, axis=1)
        values, vectors = np.linalg.eigh(cov)
        off = rng.normal(size=(draws, len(beta))) @ (vectors * np.sqrt(np.maximum(values, 0))).T @ x[future].T
        paths = yhat[future] + (drift + off) * ys + rng.normal(0, sigma, drift.shape)
        lo[future], hi[future] = np.quantile(paths, [0.1, 0.9], axis=0)
    return yhat, lo, hi


def forecast_series(df: DataFrame, keys: Sequence[str], ds: str, y: str, *, freq: str,
                    horizon: int, scales: Sequence[float], holdout: str = "fixed3",
                    min_points: int = 18, min_train: int = 5, yearly: int = 10, weekly: int = 0,
                    holidays: Sequence | None = None, lower: float | None = 0.0,
                    upper: float | None = None, clip_lower_band: bool = True,
                    clip_upper_band: bool = True) -> DataFrame:
    """Per series: tune the changepoint scale on a holdout (lowest MAE,
    ties -> first candidate), refit on the whole history, predict history +
    ``horizon`` future periods, clip (missing stays missing).

    ``holdout='fixed3'``: last 3 points, default scale when the series has
    at most 9 points (monthly ecology rule); ``holdout='fifth'``: last
    ``min(horizon, max(1, n // 5))`` points (daily mobility rule).
    Output: keys, ds, yhat, yhat_lower, yhat_upper, row_type, best_scale,
    holdout_mae (honest, model fitted without the holdout) and
    insample_mae (last 3 history points of the final model, the
    reference's number), holdout_mape, n_points and status. A series with
    fewer than ``min_points`` points gives one row with its status and no
    forecast. A seasonality needs two periods of history; ``status`` names the
    terms left out. ``holidays`` are
    (date, name) pairs; every name has an effect of its own.
    """
    keys = list(keys)
    hol_days: list[set[int]] = []
    if holidays:
        table = pd.DataFrame(list(holidays), columns=["ds", "holiday"])
        table["day"] = pd.to_datetime(table["ds"]).astype("datetime64[s]").astype("int64") // 86_400
        hol_days = [set(g["day"]) for _, g in table.groupby("holiday", sort=True)]

    def hol_flags(days: np.ndarray):
        if not hol_days:
            return None
        return np.array([[int(d) in of_name for of_name in hol_days] for d in days])

    out_schema = (", ".join(f"{k} long" for k in keys) +
                  ", ds date, yhat double, yhat_lower double, yhat_upper double, row_type string,"
                  " best_scale double, holdout_mae double, insample_mae double, holdout_mape double,"
                  " n_points long, status string")
    names = [*keys, "ds", "yhat", "yhat_lower", "yhat_upper", "row_type", "best_scale", "holdout_mae",
             "insample_mae", "holdout_mape", "n_points", "status"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key_vals = {k: int(pdf[k].iloc[0]) if pd.notna(pdf[k].iloc[0]) else None for k in keys}
        pdf = pdf.dropna(subset=[y]).sort_values(ds).drop_duplicates(ds)
        n = len(pdf)
        if n < min_points:  # Y4: a series that is too short stays in the output
            row = dict.fromkeys(names) | key_vals | {"n_points": n, "row_type": "none",
                                                     "status": f"rejected: fewer than {min_points} points"}
            return pd.DataFrame([row], columns=names)
        dts = pd.to_datetime(pdf[ds])
        days = (dts.astype("int64") // 86_400_000_000_000).to_numpy(dtype=float)
        yv = pdf[y].to_numpy(dtype=float)
        if lower is not None and freq == "D":
            yv = np.maximum(yv, lower)  # the daily rule clips the input at 0
        if holdout == "fifth":
            n_hold = int(min(horizon, max(1, n // 5)))
        else:
            n_hold = 3
        best_scale, best_mae, best_mape = float(scales[0]), float("nan"), float("nan")
        can_tune = (n - n_hold >= min_train) and (holdout == "fifth" or n > n_hold + 6)
        if can_tune:
            best_mae = float("inf")
            for s in scales:
                st = _fit(days[:-n_hold], yv[:-n_hold], s, yearly, weekly, hol_flags(days[:-n_hold]))
                pred, _, _ = _predict(st, days[-n_hold:], hol_flags(days[-n_hold:]))
                gap = np.abs(pred - yv[-n_hold:])
                mae = float(np.mean(gap))
                if mae < best_mae:
                    best_mae, best_scale = mae, float(s)
                    on = yv[-n_hold:] > 0
                    best_mape = float(np.mean(gap[on] / yv[-n_hold:][on]) * 100) if on.any() else float("nan")
        state = _fit(days, yv, best_scale, yearly, weekly, hol_flags(days))
        if freq == "MS":
            fut = pd.date_range(dts.iloc[-1], periods=horizon + 1, freq="MS")[1:]
        else:
            fut = pd.date_range(dts.iloc[-1], periods=horizon + 1, freq="D")[1:]
        all_ds = pd.DatetimeIndex(list(dts) + list(fut))
        all_days = (all_ds.astype("int64") // 86_400_000_000_000).to_numpy(dtype=float)
        yhat, lo, hi = _predict(state, all_days, hol_flags(all_days), days[-1])
        insample = float(np.mean(np.abs(yhat[n - 3:n] - yv[n - 3:n]))) if n >= 3 else float("nan")
        if lower is not None:
            yhat = np.maximum(yhat, lower)
            if clip_lower_band:
                lo = np.maximum(lo, lower)
        if upper is not None:
            yhat = np.minimum(yhat, upper)
            if clip_upper_band:
                hi = np.minimum(hi, upper)
        res = pd.DataFrame({"ds": all_ds.date, "yhat": yhat, "yhat_lower": lo, "yhat_upper": hi})
        res["row_type"] = np.where(np.arange(len(res)) < n, "historical", "forecast")
        res["best_scale"] = best_scale
        res["holdout_mae"] = best_mae
        res["insample_mae"] = insample
        res["holdout_mape"] = best_mape
        res["n_points"] = n
        out = [name for name, asked, kept in (("yearly", yearly, state[6]), ("weekly", weekly, state[7])) if asked > kept]
        res["status"] = ("tuned" if can_tune else "default scale: too short to hold out") + "".join(
            f"; no {name} terms: under two periods" for name in out)
        for k, v in key_vals.items():
            res.insert(0, k, v)
        return res[names]

    cols = [*[F.col(k).cast("long").alias(k) for k in keys], F.col(ds).cast("date").alias(ds),
            F.col(y).cast("double").alias(y)]
    return df.select(*cols).groupBy(*keys).applyInPandas(run, out_schema)
