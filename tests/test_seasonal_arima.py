import numpy as np
import pandas as pd
import pytest

from citypulse.timeseries import seasonal_arima as SA


def planted(ar, ma, sar, n, seed, season=12):
    rng = np.random.RandomState(seed)
    e, z = rng.normal(0, 1, n + 200), np.zeros(n + 200)
    for t in range(season + 1, n + 200):
        z[t] = (ar * z[t - 1] + sar * z[t - season] - ar * sar * z[t - season - 1] + e[t] + ma * e[t - 1])
    return z[200:]


@pytest.mark.parametrize("ar, ma, sar", [(0.6, 0.3, 0.5), (-0.4, 0.5, 0.7), (0.5, -0.2, -0.6), (0.3, 0.8, 0.8)])
def test_planted_parameters_are_recovered(ar, ma, sar):
    found = SA.fit(planted(ar, ma, sar, 1500, 3), 12)
    assert np.allclose(found, [ar, ma, sar], atol=0.1), found


def test_gradient_is_that_of_the_residuals():
    z, params = planted(0.5, 0.3, 0.4, 60, 1), np.array([0.2, -0.3, 0.6])
    _, grad = SA.residuals(z, params, 12)
    for j in range(3):
        step = np.eye(3)[j] * 1e-6
        up, down = SA.residuals(z, params + step, 12)[0], SA.residuals(z, params - step, 12)[0]
        assert np.allclose(grad[:, j], (up - down) / 2e-6, atol=1e-5)


def test_fit_is_the_least_sum_of_squares_of_a_grid():
    z = planted(0.5, 0.4, 0.5, 120, 8)
    cost = lambda p: float((SA.residuals(z, np.array(p), 12)[0] ** 2).sum())
    grid = np.linspace(-0.9, 0.9, 13)
    assert cost(SA.fit(z, 12)) <= min(cost((a, m, s)) for a in grid for m in grid for s in grid)


def test_parameters_stay_stationary_and_invertible():
    for seed in range(5):
        v = np.random.RandomState(seed).normal(0, 1, 40).cumsum().cumsum()
        _, params = SA.forecast(v, 3, 12)
        assert (np.abs(params) <= SA.LIMIT).all()


def test_constant_series_and_gaps(spark):
    ds = pd.date_range("2020-01-01", periods=30, freq="MS")
    ds = [d.to_pydatetime() for d in ds]
    rows = [(1, d, 5.0) for d in ds] + [(2, d, None) for d in ds] + [(None, d, float(i)) for i, d in enumerate(ds)]
    out = SA.seasonal_arima_forecast(spark.createDataFrame(rows, "k long, ds timestamp, y double"), ["k"], "ds", "y")
    by = {}
    for r in out.collect():
        by.setdefault(r.k, []).append(r)
    assert [r.forecast for r in by[1]] == [5.0] * 3 and by[1][0].holdout_mae == 0
    assert len(by[2]) == 1 and by[2][0].forecast is None and by[2][0].status == SA.SHORT
    assert len(by[None]) == 3 and all(r.status == "fitted" for r in by[None])
