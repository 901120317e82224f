"""CSV folders with drifted headers and bad rows (IO1, P7).

Files of one folder may order, name and repeat their columns differently. Only
each file's first line is read ahead, like a footer; files of one header are one
scan, whose columns are bound by name. Every row ends up in exactly one of two
tables: the rows that satisfy the declared schema, and the rejects with the
reason and the file. Nothing is dropped: rows = kept + rejected.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MALFORMED = "malformed row"
_RAW = "_raw"


def _key(name: str) -> str:
    return name.lstrip("﻿").strip().casefold()


def headers(spark: SparkSession, path: str, workers: int = 16) -> dict[str, str]:
    """file -> its first line, read through the file system of ``path``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(file: str) -> tuple[str, str | None]:
        at = jvm.org.apache.hadoop.fs.Path(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(at.getFileSystem(conf).open(at), "UTF-8"))
        try:
            return file, reader.readLine()
        finally:
            reader.close()

    # planning a scan lists the files as any read does; empty files hold no row
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(workers) as pool:
        return {file: line for file, line in pool.map(first, files) if line}


def read_quarantined(spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = (),
                     renamed: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects) of the CSV files in ``path``.

    ``kept`` has the columns of ``schema`` and ``file_name``; ``rejects`` has
    (file_name, raw, reason), ``raw`` the row's text. A row is rejected if its
    number of fields is not that of its file's header or its quotes do not close
    (``malformed row``), if a value can't be cast to its declared type
    (``<column>: not a <type>``), or if a ``required`` column is null or absent
    (``<column>: missing``); the first reason in this order of columns counts.
    Header names are compared without case, blanks around them or a byte order
    mark; ``renamed`` maps names of older files to declared ones. Of repeated
    names the first counts, unknown columns are ignored, absent ones are null.
    The literal ``NULL`` is null; quoted fields stay on one line."""
    alias = {_key(a): _key(b) for a, b in (renamed or {}).items()}
    by_header = defaultdict(list)
    for file, line in headers(spark, path).items():
        by_header[line].append(file)
    kept, rejected = [], []
    for line, files in sorted(by_header.items()):
        rows = _bound(spark, files, next(csv.reader([line])), alias, schema, required)
        kept.append(rows.where("reason is null").select(*schema.names, "file_name"))
        rejected.append(rows.where("reason is not null").select("file_name", "raw", "reason"))
    if not kept:
        named = StructType([*schema.fields, StructField("file_name", StringType())])
        return (spark.createDataFrame([], named),
                spark.createDataFrame([], "file_name string, raw string, reason string"))
    return _union(kept), _union(rejected)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _bound(spark, files, names, alias, schema, required) -> DataFrame:
    """One scan of files of one header: declared columns, file_name, raw, reason."""
    fields = [StructField(f"c{i}", StringType()) for i in range(len(names))]
    # a pruned parse would not see that a row has too many or too few fields, so
    # which columns are used later must not change what is malformed
    scan = (spark.read.option("columnPruning", False).schema(StructType([*fields, StructField(_RAW, StringType())]))
            .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
            .option("nullValue", "NULL").option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(files))
    position: dict[str, int] = {}
    for i, name in enumerate(names):
        position.setdefault(alias.get(_key(name), _key(name)), i)
    cols, checks = [], []
    for field in schema:
        at = position.get(_key(field.name))
        text = F.lit(None).cast("string") if at is None else F.col(f"c{at}")
        value = text if isinstance(field.dataType, StringType) else F.trim(text).try_cast(field.dataType)
        cols.append(value.alias(field.name))
        checks.append(F.when(text.isNotNull() & value.isNull(),
                             F.lit(f"{field.name}: not a {field.dataType.simpleString()}")))
        if field.name in required:
            checks.append(F.when(value.isNull(), F.lit(f"{field.name}: missing")))
    # always true; a scan may not be asked for its corrupt-record column alone
    parsed = F.length(F.coalesce("c0", F.lit(""))) >= 0
    reason = F.coalesce(F.when(F.col(_RAW).isNotNull() & parsed, F.lit(MALFORMED)), *checks)
    whole = F.to_csv(F.struct(*[f.name for f in fields]), {
        "nullValue": "NULL", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return scan.select(*cols, F.col("_metadata.file_name").alias("file_name"),
                       F.coalesce(_RAW, whole).alias("raw"), reason.alias("reason"))
