"""Nested evaluation reports as one VARIANT document (M15, IO9, IO10).

A report is one row with a ``document``: an object of sections, each an object of
fields of any shape (numbers, lists, objects). Every section is computed on its
own, so a failing one becomes the field ``error`` and hides none of the others.
Documents are written as JSON, read back without a declared schema, merged by
path and queried by path. A document's size is that of its sections' results,
which are aggregates and dimension-sized lists, never fact rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from citypulse.operators.materialize import stage

log = logging.getLogger("citypulse")

METADATA = "metadata"


def _body(df: DataFrame) -> DataFrame:
    """(body): the one row of ``df`` as an object, computed and staged. A column
    without a type is a null field."""
    cols = [F.col(f"`{f.name}`").cast("string" if isinstance(f.dataType, NullType) else f.dataType).alias(f.name)
            for f in df.schema]
    found = stage(df.select(F.to_variant_object(F.struct(*cols)).alias("body")), "section")
    n = found.count()
    if n != 1:
        raise ValueError(f"{n} rows where one was expected")
    return found


def _object(name: str, value: str) -> Column:
    return F.to_variant_object(F.map_from_entries(F.collect_list(F.struct(name, value))))


def build_document(spark: SparkSession, sections: Mapping[str, Callable[[], DataFrame]], generated_at: str) -> DataFrame:
    """One row (document). Each section is a function returning one row; what it
    raises is kept as ``error`` (its error condition, or else its type and text).
    ``metadata`` holds ``generated_at`` and ``overall_status``: OK, PARTIAL or
    FAILED."""
    parts, failed = [], 0
    for name, build in sections.items():
        try:
            body = _body(build())
        except Exception as e:  # noqa: BLE001  a report must survive any failing section
            log.warning("report section %s failed: %s", name, str(e).split("\n", 1)[0])
            condition = e.getCondition() if isinstance(e, PySparkException) else None
            failed += 1
            body = _body(spark.range(1).select(F.lit(condition or f"{type(e).__name__}: {e}"[:500]).alias("error")))
        parts.append(body.select(F.lit(name).alias("section"), "body"))
    status = "OK" if not failed else "PARTIAL" if failed < len(sections) else "FAILED"
    parts.append(spark.range(1).select(F.lit(METADATA).alias("section"), F.to_variant_object(F.struct(
        F.lit(generated_at).alias("generated_at"), F.lit(status).alias("overall_status"))).alias("body")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.agg(_object("section", "body").alias("document"))


def write_document(document: DataFrame, path: str) -> None:
    """IO9: one JSON document per line."""
    document.select(F.to_json("document").alias("value")).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """IO10: documents as VARIANT, whatever their fields."""
    return spark.read.option("singleVariantColumn", "document").json(path)


def fields(documents: DataFrame, *keep: str) -> DataFrame:
    """(*keep, section, field, value) of every field of every document."""
    spark = documents.sparkSession
    outer = documents.lateralJoin(spark.tvf.variant_explode(F.col("document").outer()).select(
        F.col("key").alias("section"), F.col("value").alias("body")))
    return outer.select(*keep, "section", "body").lateralJoin(
        spark.tvf.variant_explode(F.col("body").outer()).select(F.col("key").alias("field"), "value")).drop("body")


def merge_documents(older: DataFrame, newer: DataFrame) -> DataFrame:
    """One document with the fields of both by path (section, field); the newer
    value wins. A section that the newer document computes loses an older
    ``error``, and the overall status is that of the merged sections."""
    both = older.select(F.lit(0).alias("age"), "document").unionByName(newer.select(F.lit(1).alias("age"), "document"))
    every = fields(both, "age")
    per = every.groupBy("section", "field").agg(F.max_by("value", "age").alias("value"), F.max("age").alias("age"))
    last = every.groupBy("section").agg(F.max("age").alias("last"))
    kept = per.join(last, "section").where("field != 'error' or age = last")
    bodies = kept.groupBy("section").agg(_object("field", "value").alias("body"),
                                         F.max((F.col("field") == "error").cast("int")).alias("failed"))
    counts = bodies.where(F.col("section") != METADATA).agg(
        F.sum("failed").alias("failed"), F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("failed") == 0, "OK").when(F.col("failed") < F.col("n"), "PARTIAL").otherwise("FAILED").alias("s"))
    moment = F.try_variant_get("body", "$.generated_at", "string")
    body = F.when(F.col("section") == METADATA, F.to_variant_object(F.struct(
        moment.alias("generated_at"), counts.select("s").scalar().alias("overall_status")))).otherwise(F.col("body"))
    bodies = bodies.select("section", body.alias("body"))
    return bodies.agg(_object("section", "body").alias("document"))


def at(path: str, as_type: str = "string") -> Column:
    """The value at a path of ``document``, null where there is none."""
    return F.try_variant_get("document", path, as_type)
