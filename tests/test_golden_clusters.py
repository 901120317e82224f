"""Golden tier: the published safety zone profile reproduces the published
cluster metrics with population-std scaling."""

import pytest
from pyspark.sql import functions as F

from citypulse.operators.encode import pop_standardize
from citypulse.operators.models.cluster import cluster_quality, rank_labels

# The reference's published 10-zone risk profile
# (zone_sk, risk_cluster_id, nb_accidents, nb_graves, volume_crimes,
#  taux_criminalite, usagers_vulnerables) and its cluster labels.
GOLDEN_PROFILE = [
    (1, 2, 0.08333333333333333, 0.0, 25.75, 1.4829166666666669, 0.0),
    (2, 0, 0.10526315789473684, 0.0, 26.0, 0.8393, 0.021052631578947368),
    (3, 1, 0.14583333333333334, 0.041666666666666664, 27.666666666666668, 0.7093958333333333, 0.041666666666666664),
    (4, 2, 0.020942408376963352, 0.0, 26.141361256544503, 1.2448534031413612, 0.0),
    (5, 0, 0.09947643979057591, 0.020942408376963352, 25.785340314136125, 1.031413612565445, 0.05759162303664921),
    (6, 0, 0.18947368421052632, 0.021052631578947368, 24.657894736842106, 0.8218684210526316, 0.042105263157894736),
    (7, 2, 0.020942408376963352, 0.0, 26.701570680628272, 0.793261780104712, 0.0),
    (8, 0, 0.125, 0.0, 25.020833333333332, 0.8794791666666667, 0.0),
    (9, 1, 0.10471204188481675, 0.020942408376963352, 27.287958115183248, 0.7797172774869109, 0.041884816753926704),
    (10, 1, 0.14659685863874344, 0.041884816753926704, 26.51832460732984, 0.8286492146596858, 0.0),
]
GOLDEN_LEVELS = {0: "Low risk", 1: "High risk", 2: "Medium risk"}
FEATS = ["nb_accidents", "nb_graves", "volume_crimes", "taux_criminalite", "usagers_vulnerables"]


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame(GOLDEN_PROFILE, ["zone_sk", "cluster_id", *FEATS])


def test_golden_inertia_db(profile):
    scaled = pop_standardize(profile, FEATS)
    q = cluster_quality(scaled, [f"{c}_scaled" for c in FEATS]).first()
    assert q["inertia"] == pytest.approx(20.6916, abs=1e-4)
    assert q["k"] == 3 and -1 <= q["silhouette"] <= 1
    assert q["davies_bouldin"] == pytest.approx(1.0689, abs=1e-4)


def test_golden_rank_labels_use_raw_means(profile):
    lab = rank_labels(profile, FEATS).select("cluster_id", "risk_level").distinct().collect()
    assert {r["cluster_id"]: r["risk_level"] for r in lab} == GOLDEN_LEVELS
