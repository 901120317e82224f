"""Stages written to the shared folder.

A stage is a Parquet table below the folder that ``spark.checkpoint.dir``
names, so it is column-pruned when reread, has size statistics for the join
planner, and survives the loss of the executors that computed it.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.session import ensure_checkpoint_dir

_MADE: list[tuple[SparkSession, str]] = []


def stage_path(spark: SparkSession, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


def staged(df: DataFrame, name: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` once and return it reread as a leaf."""
    path = stage_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Spark's own setting: the shuffle files of a query go when the query ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(df: DataFrame, name: str = "stage") -> DataFrame:
    """``staged``, and the shuffle files that the write needed are removed at its
    end instead of at some later garbage collection of the driver: the table
    that replaces them is written by then. The table is packed tightly, as it
    lies beside the shuffle files of the steps that read it."""
    spark = df.sparkSession
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        return staged(df, name, "zstd")
    finally:
        spark.conf.set(RELEASE, before)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The paths that operators stage inside the block, for ``remove``."""
    start = len(_MADE)
    paths: list[str] = []
    try:
        yield paths
    finally:
        paths += [p for _, p in _MADE[start:]]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes stages whose readers are done."""
    for path in paths:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    gone = set(paths)
    _MADE[:] = [x for x in _MADE if x[1] not in gone]


# A staged table of keys up to this many rows (tens of MB) is broadcast;
# beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame) -> DataFrame:
    """A staged table of keys as the small side of a join, its size counted."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


@atexit.register
def _clean() -> None:
    """Remove this process's stages when the application ends."""
    for spark, path in _MADE:
        try:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        except Exception:  # the session is gone; the folder is the caller's scratch space
            return
