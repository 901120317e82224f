"""Sinks (IO6-IO10, IO13).

Every writer is a plain DataFrame writer (executors write in parallel, no
driver collection). BI tables are written as CSV with a header (the BI
tool reads those) and optionally as parquet partitioned by year.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("citypulse")


def write_bi_table(df: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None) -> None:
    """IO7: overwrite a BI output table (CSV with header, or parquet)."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_back(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """IO6: read one of our own outputs back."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)


def write_jdbc(df: DataFrame, url: str | None, table: str, properties: Mapping[str, str] | None = None,
               enabled: bool = False) -> bool:
    """IO8: optional relational sink in replace mode, off by default and
    non-fatal: a failure is logged and reported, never raised."""
    if not enabled or not url:
        return False
    try:
        df.write.mode("overwrite").jdbc(url, table, properties=dict(properties or {}))
        return True
    except Exception as e:  # noqa: BLE001
        log.warning("JDBC export of %s failed: %s", table, e)
        return False


def write_report(report: DataFrame, path: str) -> None:
    """IO9: a nested report (one row of structs / maps / arrays) as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """IO10: read a JSON report back (to merge sections)."""
    return spark.read.json(path)


def build_report(spark: SparkSession, sections: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """(section, status, metrics JSON, error), one row per section.

    Sections are evaluated one by one, each a single row of metrics, so one
    that fails is recorded and hides none of the others. ``overall`` is OK only
    when every section is."""
    rows = []
    for name, build in sections.items():
        try:
            found = build().select(F.to_json(F.struct("*")).alias("j")).take(2)
            if len(found) != 1:
                raise ValueError(f"{len(found)} rows where one was expected")
            rows.append((name, "OK", found[0]["j"], None))
        except Exception as e:  # noqa: BLE001  a report must survive any failing section
            log.warning("report section %s failed: %s", name, e)
            rows.append((name, "FAILED", None, f"{type(e).__name__}: {e}"[:500]))
    overall = "OK" if all(r[1] == "OK" for r in rows) else "PARTIAL" if any(r[1] == "OK" for r in rows) else "FAILED"
    return spark.createDataFrame([(*r, overall) for r in rows],
                                 "section string, status string, metrics string, error string, overall string")


def verify_outputs(spark: SparkSession, expected: Mapping[str, tuple[str, int | None]]) -> DataFrame:
    """IO13: presence and row count of each output: {name: (path, expected rows or None)}."""
    rows = []
    for name, (path, n_expected) in expected.items():
        try:
            n = spark.read.option("header", True).csv(path).count()
            ok = n_expected is None or n == n_expected
            rows.append((name, path, True, int(n), n_expected, ok))
        except Exception:  # noqa: BLE001
            rows.append((name, path, False, None, n_expected, False))
    return spark.createDataFrame(rows, "name string, path string, present boolean, n_rows long, "
                                       "n_expected long, ok boolean")
