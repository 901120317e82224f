"""Readers for the warehouse tables (IO1-IO5).

Parquet is the default format. CSV readers take an explicit schema so the
job never runs an inference pass over a large file, keep leading blanks
(zone names carry them) and map the literal ``NULL`` to SQL NULL.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Reference-format dimension schemas (all fields are quoted text in the files).
DIM_ZONE_SCHEMA = T.StructType([
    T.StructField("zone_sk", T.IntegerType()),
    T.StructField("zone_nom", T.StringType()),
    T.StructField("ville", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("zone_code", T.StringType()),
])
DIM_LIGNES_SCHEMA = T.StructType([
    T.StructField("line_sk", T.IntegerType()),
    T.StructField("line_nom", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("couleur", T.StringType()),
    T.StructField("operateur", T.StringType()),
    T.StructField("actif", T.BooleanType()),
    T.StructField("mode_code", T.StringType()),
])
DIM_MODE_SCHEMA = T.StructType([
    T.StructField("mode_code", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("mode_sk", T.IntegerType()),
])
DIM_ARRET_SCHEMA = T.StructType([
    T.StructField("stop_code", T.StringType()),
    T.StructField("stop_nom", T.StringType()),
    T.StructField("ville", T.StringType()),
    T.StructField("zone_fk", T.IntegerType()),
    T.StructField("accessibilite", T.StringType()),
    T.StructField("stop_sk", T.IntegerType()),
    T.StructField("zone_code", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """IO1/IO2/IO5: header CSV with a declared schema (no inference pass)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "NULL")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_optional(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  fmt: str = "csv") -> DataFrame | None:
    """IO4: a source that may be absent; the caller skips its join on ``None``."""
    if not _exists(spark, path):
        return None
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.format(fmt).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)
