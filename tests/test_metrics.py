import itertools

import numpy as np
import pandas as pd
import pytest

from citypulse.operators import curves as CU
from citypulse.operators import metrics as MT


def _scores(spark, n=400, seed=5):
    rng = np.random.RandomState(seed)
    y = (rng.rand(n) < 0.2).astype(int)
    s = np.round(rng.rand(n) * 0.6 + 0.3 * y, 2)   # ties on purpose
    return pd.DataFrame({"y": y, "s": s}), spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))


def test_auc_equals_pairwise_definition(spark):
    pdf, df = _scores(spark)
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    brute = np.mean([(p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg)])
    assert CU.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(brute, abs=1e-12)


def test_best_f1_threshold_brute_force(spark):
    pdf, df = _scores(spark)
    best = None
    for t in sorted(pdf.s.unique()):
        pred = (pdf.s >= t).astype(int)
        tp = int(((pred == 1) & (pdf.y == 1)).sum())
        fp = int(((pred == 1) & (pdf.y == 0)).sum())
        fn = int(((pred == 0) & (pdf.y == 1)).sum())
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        if best is None or f1 > best[1] + 1e-15:
            best = (t, f1)
    got = CU.best_f1_threshold(df, "y", "s").first()
    assert got["threshold"] == pytest.approx(best[0])
    assert got["f1"] == pytest.approx(best[1])


def test_golden_confusion_recount(spark):
    # The reference's published confusion matrix at 0.5.
    rows = [(0, 0)] * 849 + [(0, 1)] * 13 + [(1, 0)] * 16
    df = spark.createDataFrame(rows, "y int, p int")
    cm = {(r["actual"], r["predicted"]): r["n"] for r in MT.confusion_counts(df, "y", "p", [0, 1]).collect()}
    assert cm == {(0, 0): 849, (0, 1): 13, (1, 0): 16, (1, 1): 0}
    sc = MT.binary_scores(df, "y", "p").first()
    assert (sc["precision"], sc["recall"], sc["f1"]) == (0.0, 0.0, 0.0)


def test_regression_metrics(spark):
    pdf = pd.DataFrame({"y": [1.0, 2.0, 3.0, 4.0], "p": [1.5, 2.0, 2.0, 5.0]})
    m = MT.regression_metrics(spark.createDataFrame(pdf), "y", "p").first()
    e = pdf.y - pdf.p
    assert m["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert m["r2"] == pytest.approx(1 - (e ** 2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum())
