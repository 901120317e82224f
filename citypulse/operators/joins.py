"""Join operators.

Broadcast policy: a side is broadcast by hint only when the caller states that
its size is bounded by construction (a calendar). Everything
else is left to AQE, which converts a join to broadcast from the *measured*
runtime size and otherwise keeps the shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, key: str | Sequence[str],
                   cols: Sequence[str] | None = None, bounded: bool = False) -> DataFrame:
    """Fact LEFT JOIN dim on the surrogate key.

    ``bounded=True`` asserts that the dimension's row count is bounded
    independently of the fact (a calendar) and hints a broadcast; otherwise
    the planner decides from sizes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if cols is not None:
        dim = dim.select(*keys, *[c for c in cols if c in dim.columns and c not in keys])
    dup = [c for c in dim.columns if c in fact.columns and c not in keys]
    dim = dim.drop(*dup)
    side = F.broadcast(dim) if bounded else dim
    return fact.join(side, on=keys, how="left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; ``keys`` come from ``left``."""
    if not keys:
        return left.join(right, on=F.lit(True), how=how)
    renamed = right.select(*[F.col(c).alias(f"_ns_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_ns_{k}")) for k in keys]
    return left.join(renamed, on=on, how=how).drop(*[f"_ns_{k}" for k in keys])


def names_with_default(profile: DataFrame, names: DataFrame, key: str = "zone_sk",
                       name_col: str = "zone_nom", prefix: str = "Zone_") -> DataFrame:
    """Attach a name per key from the distinct (key, name) pairs, else a
    synthetic ``<prefix><key>``. The first name per key wins (min), so a key
    with several spellings still gives one row."""
    distinct_names = names.groupBy(key).agg(F.min(name_col).alias(name_col))
    return (profile.join(distinct_names, on=key, how="left")
                   .withColumn(name_col, F.coalesce(F.col(name_col),
                                                    F.concat(F.lit(prefix), F.col(key).cast("string")))))


def lookup_with_default(df: DataFrame, table: DataFrame, keys: Sequence[str], value: str,
                        default: Column, out: str | None = None) -> DataFrame:
    """Map lookup (single or composite key) with a default for misses;
    a missing key is a miss."""
    out = out or value
    t = table.select(*keys, F.col(value).alias("_lk_v"))
    return (df.join(t, on=list(keys), how="left")
              .withColumn(out, F.coalesce(F.col("_lk_v"), default)).drop("_lk_v"))


def outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several frames on ``keys`` (keys coalesced by
    the USING join)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, on=list(keys), how="full")
    return out


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent (NULL keys included)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, child[child_key] == p["_pk"], "left_anti")


def semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with a match in ``other``."""
    return df.join(other.select(*keys), on=list(keys), how="left_semi")
