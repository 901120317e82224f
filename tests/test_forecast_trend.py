"""Sparse changepoints and simulated intervals of the additive forecaster."""

import numpy as np

from citypulse.timeseries.forecast import _fit, _predict


def walk(rng, n, horizon, scale=0.3, noise=0.03):
    """A series of the model's own form: 25 places for slope changes over the
    first 80 % of the history, none in its last fifth, and more at the same rate
    after it."""
    t = np.arange(n + horizon) / (n - 1)
    slope = rng.normal(0, 0.5)
    y = 1 + slope * t
    for c in np.arange(0, t[-1], 0.8 / 25):
        if 0.8 <= c < 1:
            continue
        y = y + rng.laplace(0, scale) * np.maximum(0, t - c)
    return y + rng.normal(0, noise, len(y))


def test_a_planted_change_is_found_and_the_others_vanish():
    rng = np.random.default_rng(1)
    t = np.arange(200.0)
    y = 10 + 0.02 * t + 0.15 * np.maximum(0, t - 96) + rng.normal(0, 0.1, 200)
    t0, span, cps, beta, ys, sigma, *_ = _fit(t, y, 0.05, 0, 0, None)
    change = np.abs(beta[2:2 + len(cps)])
    place = cps * span
    near = np.abs(place - 96) < 15
    assert change[near].sum() > 0.85 * change.sum()
    assert (change < 0.02 * change.max()).sum() > len(cps) / 2
    assert abs(sigma - 0.1) < 0.03


def test_intervals_widen_with_the_horizon():
    rng = np.random.default_rng(2)
    y = walk(rng, 150, 0)
    t = np.arange(150.0)
    state = _fit(t, y, 0.3, 0, 0, None)
    every = np.arange(210.0)
    _, lo, hi = _predict(state, every, None, t[-1])
    width = hi - lo
    assert np.allclose(width[:150], width[0]) and width[-1] > width[155] > 0 and width[-1] > 1.5 * width[149]


def test_coverage_of_the_intervals():
    rng = np.random.default_rng(3)
    hit = []
    for _ in range(150):
        y = walk(rng, 120, 24)
        t = np.arange(144.0)
        state = _fit(t[:120], y[:120], 0.3, 0, 0, None)
        _, lo, hi = _predict(state, t, None, t[119])
        hit.append(np.mean((y[120:] >= lo[120:]) & (y[120:] <= hi[120:])))
    print("coverage", np.mean(hit))
    assert 0.75 <= np.mean(hit) <= 0.85
