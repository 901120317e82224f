import math

import numpy as np
import pytest

from citypulse.llm import whitening as W


def brute(rows, components=4):
    """All rows whitened with numpy's eigenvectors; rows (vec_id, vector)."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(v) for _, v in kept})
    n = len(fit)
    x = np.array(fit, float)
    s = [sum(c) for c in zip(*fit)]
    mean = x.mean(axis=0)
    v = (x - mean).T @ (x - mean) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, r in kept:
        deviation = sum((n * a - b) ** 2 for a, b in zip(r, s))
        for k in range(min(components, len(s))):
            out.append((i, k + 1, n, deviation, float((np.array(r) - mean) @ u[:, k] / np.sqrt(e[k])), e[k] / np.trace(v)))
    return out


def compare(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0], r[1], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    sign = {}
    for g, w in zip(got, want):
        assert g[:4] == w[:4]
        if abs(w[4]) > 1e-3:
            sign.setdefault(w[1], math.copysign(1, g[4]) * math.copysign(1, w[4]))
    for g, w in zip(got, want):
        assert g[4] == pytest.approx(sign[w[1]] * w[4], abs=1e-8)
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert 0 <= g[6] < 1e-9


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def vectors(seed, n, dim):
    r = np.random.default_rng(seed)
    mixed = r.normal(0, 1, (n, dim)) * np.linspace(2, 0.1, dim) @ np.linalg.qr(r.normal(size=(dim, dim)))[0] + 0.7
    return [(i, v) for i, v in enumerate(mixed.astype(np.float32).tolist())]


def test_against_numpy(spark):
    rows = vectors(1, 400, 24)
    rows = [(i, rows[3][1] if i % 3 == 0 else v) for i, v in rows]  # a third is one vector
    rows += [(5, rows[5][1]), (900, None), (901, [None] * 24), (902, [float("nan")] * 24), (903, [float("-inf")] * 24)]
    out = W.whitened(frame(spark, rows).repartition(4))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(out.collect(), brute(rows))


def test_real_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    compare(W.whitened(df).collect(), brute(rows))


def test_degenerate_tables(spark):
    assert W.whitened(frame(spark, [])).count() == 0
    assert W.whitened(frame(spark, [(1, None), (2, [float("nan")] * 3), (3, [])])).count() == 0
    one = W.whitened(frame(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25])])).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["n"] == 1 and r["deviation"] == 0 for r in one)
    # two dimensions of variance out of five: two components have a value
    flat = [(i, [i / 10, (i * i % 7) / 3, 0.5, 0.5, 0.5]) for i in range(20)]
    out = W.whitened(frame(spark, flat).selectExpr("*", "'x' as x", "1 as n", "2 as component", "3 as whitened")).collect()
    assert {r["component"] for r in out if r["whitened"] is not None} == {1, 2}
    assert out[0]["identity_error"] < 1e-9


def test_a_null_or_repeated_id_and_another_length(spark):
    rows = [(None, [0.1, 0.9]), (4, [0.7, 0.2]), (4, [0.3, 0.4]), (5, [0.9, -0.4]), (6, [1.0])]
    out = W.whitened(frame(spark, rows)).collect()
    assert len(out) == 8 and {r["n"] for r in out} == {4}


def test_deviation_is_exact_beyond_doubles(spark):
    w = W.Whitener.__new__(W.Whitener)
    w.n, w.size, w.sums = 10 ** 9, 2, np.array([3, -5])
    assert w.deviation(np.array([[1, 1], [10 ** 5, 0]])) == [(10 ** 9 - 3) ** 2 + (10 ** 9 + 5) ** 2, None]


def spectra():
    r = np.random.default_rng(9)
    yield r.random(40)
    yield np.arange(33.0)
    yield np.repeat([5.0, 2.0, 1.0], [3, 10, 7])  # equal eigenvalues
    yield np.array([1e9, 1.0, 1e-3, 0.0, 0.0])
    yield np.concatenate([[3.0], np.full(20, 1e-16)])
    yield np.array([4.0])
    yield np.zeros(6)
    yield np.array([2.0, 2.0 + 1e-9, 2.0 - 1e-9, 1.0])


@pytest.mark.parametrize("values", list(spectra()), ids=lambda v: str(len(v)))
def test_spectrum(values):
    r = np.random.default_rng(len(values))
    q = np.linalg.qr(r.normal(size=(len(values), len(values))))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, u = W.spectrum(a)
    size = max(values.max(), 1e-300)
    assert np.allclose(np.sort(values)[::-1], e, atol=1e-13 * size * len(values))
    assert np.allclose(u.T @ u, np.eye(len(values)), atol=1e-12)
    assert np.abs(a @ u - u * e).max() <= 1e-12 * size * len(values)
    top, v = W.spectrum(a, 4)
    assert np.allclose(top[:4], e[:4], atol=1e-12 * size * len(values))
    assert np.abs(a @ v - v * top).max() <= 1e-12 * size * len(values)


def test_polar_factor():
    r = np.random.default_rng(2)
    a = r.normal(size=(30, 30))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.allclose(W.polar(a), (v * np.sign(e)) @ v.T, atol=1e-12)
