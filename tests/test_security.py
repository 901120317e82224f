"""Row-level security by the session's principal."""

import pytest
from pyspark.sql import functions as F

from citypulse.plans import bi as B


@pytest.fixture
def tables(spark):
    zones = spark.createDataFrame([(1, "EUROPE"), (2, "EUROPE"), (3, "ASIA"), (4, "AFRICA")], "zone_sk int, ville string")
    grants = spark.createDataFrame([("alice", "region", "EUROPE"), ("bob", "region", "ASIA"), ("bob", "zone", "1"),
                                    ("bob", "zone", "1"), ("dan", "zone", "nowhere"), ("eve", "zone", "99")],
                                   "principal string, kind string, value string")
    facts = spark.createDataFrame([(k, 1 + k % 5) for k in range(50)], "id int, zone_sk int")
    return zones, grants, facts


def seen(spark, tables, who):
    zones, grants, facts = tables
    B.act_as(spark, who)
    rows = B.secured(facts, B.role_entitlements(zones, grants))
    return rows


def test_each_principal_sees_the_zones_of_all_its_roles(spark, tables):
    want = {"alice": {1, 2}, "bob": {1, 3}, "carol": set(), "dan": set(), "eve": set(), "o'neill": set()}
    for who, zones in want.items():
        rows = seen(spark, tables, who).collect()
        assert {r["zone_sk"] for r in rows} == zones and len(rows) == 10 * len(zones)


def test_an_earlier_frame_keeps_its_principal(spark, tables):
    alice = seen(spark, tables, "alice")
    bob = seen(spark, tables, "bob")
    assert {r["zone_sk"] for r in bob.collect()} == {1, 3} and {r["zone_sk"] for r in alice.collect()} == {1, 2}


def test_a_dynamic_role_follows_the_dimension(spark, tables):
    zones, grants, facts = tables
    moved = zones.withColumn("ville", F.when(F.col("zone_sk") == 4, "EUROPE").otherwise(F.col("ville")))
    B.act_as(spark, "alice")
    assert {r["zone_sk"] for r in B.secured(facts, B.role_entitlements(moved, grants)).collect()} == {1, 2, 4}


def test_the_filter_stands_below_the_aggregate(spark, tables):
    plan = seen(spark, tables, "alice").groupBy("zone_sk").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    B.act_as(spark, None)
    assert seen(spark, tables, None).count() == 0  # the session's own user has no grant
