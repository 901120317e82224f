"""P5: key de-duplication keeping the first row in a given order.

pandas ``drop_duplicates`` keeps the first row in file order; Spark's
``dropDuplicates`` keeps an arbitrary one. Here "first" is the minimum of a
struct whose leading fields are the order columns. Whole rows in an aggregate's
buffer would have Spark sort the table, so the least value of the first order
column is found per key before: a hash aggregate over the keys and that one
column, which forwards one row per key and map task. Only rows that hold it
are read whole and compared by the struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.operators.joins import null_safe_join
from citypulse.operators.materialize import stage


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``order`` should be a total order (add tiebreaks); when whole rows tie,
    any of them is the same row. Output keeps the input column order. The least
    values are written as a stage, so ``df`` is read twice."""
    keys, lead = list(keys), order[0]
    least = df.groupBy(*keys).agg(F.min(lead).alias("_least"), F.max(F.col(lead).isNull()).alias("_none"))
    # a null is the least value of a struct's field
    least = stage(least.select(*keys, F.when(~F.col("_none"), F.col("_least")).alias(lead)), "least")
    # by the values first: a predicate on one column passes below the joins that made ``df``
    held = least.select(F.col(lead).alias("_lead")).where(F.col("_lead").isNotNull())
    some = df.where(F.col(lead).isNull() | F.col(lead).isin(held))
    some = null_safe_join(some, least, [*keys, lead], "left_semi")
    payload = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_first")
    agg = some.groupBy(*keys).agg(first)
    return agg.select(*keys, "_first.*").select(*df.columns)
