"""Session helpers.

The library never creates its own cluster configuration: on a cluster the
session comes from the caller. ``local_session`` exists for tests, the bench
and the driver smoke run only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on. AQE re-plans joins from
# runtime sizes (a broadcast only happens behind that measured size check),
# coalesces small shuffle partitions and splits skewed join partitions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.exchange.reuse": "true",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "citypulse") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Python workers of this machine are reached without TCP's acknowledgement delays
        .config("spark.python.unix.domain.socket.enabled", "true")
        # small local inputs: let AQE keep enough partitions to use every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is respected as is.
    Only where it is unset and every task runs in this process (``local[*]``)
    a scratch folder is created; elsewhere executors could not see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="citypulse-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
