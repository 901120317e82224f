"""Driver contract on the smallest scale factor: the flagship runs, and a
set of queries agree with their DuckDB oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
FAST = ["eco_clean_facts", "carbon_intensity_by_zone", "mob_trip_features", "mob_daily_congestion",
        "safe_severity_features", "safe_precision_at_k", "metrics_roc_auc", "eco_aqi_decomposition",
        "metrics_contiguous_kfold", "bi_hotspots"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "carbon_intensity_median" in df.columns


def test_every_query_has_docstring_and_oracle_columns():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 60
    for name, fn in qs.items():
        assert fn.__doc__, name
    assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    drows = cur.fetchall()
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, [d[0] for d in cur.description])[0]


@pytest.mark.parametrize("name", ["carbon_intensity_by_zone", "kpi_carbon_summary",
                                  "safe_precision_at_k", "mob_load_encodings", "metrics_roc_auc"])
def test_plans_have_no_cartesian_or_nested_loop_join(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
