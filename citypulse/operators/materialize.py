"""Lineage cuts.

Multi-pass operators (block prefix sums, exact quantiles, iterative model
fits) read their input several times; when that input is itself the output
of such operators the logical plan grows with every level. A stage output
is therefore written once as a reliable checkpoint in the shared folder
named by ``spark.checkpoint.dir`` (never a local checkpoint: it must survive
the loss of the executor that computed it) and read back as a leaf.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from citypulse.session import ensure_checkpoint_dir

_WRITTEN: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return it re-read as a leaf."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and return it
    re-read: later steps prune its columns and the planner knows its size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_stages() -> None:
    """Stages are removed when the application ends."""
    for spark, path in _WRITTEN:
        try:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        except Exception:  # the session has ended before its stages could be removed
            return
