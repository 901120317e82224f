"""Order-dependent operators that stay distributed when one group is huge.

pandas answers "position of a row inside its group", "running total" and
"exact median" by sorting one in-memory frame. The plain Spark translation -
``row_number().over(Window.partitionBy(g).orderBy(o))`` or a global
``Window.orderBy`` - sends a whole group (or the whole table) to one task.

Here every such question goes through **block prefix sums**:

1. ``repartitionByRange`` on ``(group, order)`` cuts the data into contiguous,
   balanced ranges; a hot group spans many ranges (blocks) instead of landing
   in one task. The ranges are written once as a Parquet stage whose block
   number is the range's partition id, so every later step reads that stage
   and a lost executor can't change the blocks;
2. a window partitioned by ``(block, group)`` computes the local running sum
   and the block total (each window holds at most one block);
3. block totals (at most ``#groups + #blocks`` rows) get their exclusive
   prefix sum per group and are joined back (AQE broadcasts that small side
   from its measured size).

NULL group keys form a group of their own, as in ``GROUP BY``: every join back
compares keys null-safely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.operators.joins import null_safe_join
from citypulse.operators.materialize import materialize, stage

_BLK = "_cp_blk"


def _num_blocks(df: DataFrame, num_blocks: int | None) -> int:
    if num_blocks:
        return num_blocks
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_block(df: DataFrame, keys: Sequence[str], num_blocks: int | None = None,
               name: str = _BLK) -> DataFrame:
    """``df`` as a written stage with a block number, monotone in the ``keys``
    tuple, that cuts it into about ``num_blocks`` contiguous ranges. Balance
    depends on Spark's range sample; correctness does not."""
    n = _num_blocks(df, num_blocks)
    ranged = df.repartitionByRange(n, *keys) if keys else df.repartition(n)
    return stage(ranged.withColumn(name, F.spark_partition_id()), "blocks")


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str],
                   by: Sequence[str] = (), inclusive: bool = True,
                   prefix: str = "cum_", num_blocks: int | None = None,
                   totals: str | None = None) -> DataFrame:
    """Add ``<prefix><v>``: sum of ``v`` over the rows up to this one (``inclusive``)
    or strictly before it, along ascending ``order`` within ``by``.

    ``order`` must be a total order inside each group (include a unique id).
    ``totals`` adds ``<totals><v>``, the group's sum: it comes with the block's
    offsets, so a group's rows needn't meet in one task.
    """
    by, order = list(by), list(order)
    blocked = with_block(df, [*by, *order], num_blocks)
    w_blk = Window.partitionBy(_BLK, *by)
    w_run = w_blk.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blocked
    for v in values:
        local = local.withColumn(f"_cp_loc_{v}", F.sum(v).over(w_run))
    blocks = blocked.groupBy(*by, _BLK).agg(*[F.sum(v).alias(f"_cp_tot_{v}") for v in values])
    # at most (#groups + #blocks) rows: each group's blocks are few
    w_off = Window.partitionBy(*by).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *by, _BLK,
        *[F.coalesce(F.sum(f"_cp_tot_{v}").over(w_off), F.lit(0)).alias(f"_cp_off_{v}")
          for v in values],
        *([F.sum(f"_cp_tot_{v}").over(Window.partitionBy(*by)).alias(f"{totals}{v}") for v in values] if totals else []))
    out = null_safe_join(local, offsets, [*by, _BLK])
    for v in values:
        cum = F.col(f"_cp_off_{v}") + F.col(f"_cp_loc_{v}")
        if not inclusive:
            cum = cum - F.coalesce(F.col(v), F.lit(0))
        out = out.withColumn(f"{prefix}{v}", cum)
    return out.drop(_BLK, *[f"_cp_off_{v}" for v in values], *[f"_cp_loc_{v}" for v in values])


def ordered_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                  name: str = "pos", num_blocks: int | None = None, size: str | None = None) -> DataFrame:
    """0-based position of each row within ``by`` along ``order`` (a total
    order), and its group's number of rows as ``size``. Equals ``row_number() - 1`` over
    ``Window.partitionBy(by).orderBy(order)`` (pandas ``cumcount``) without
    putting a group in one task."""
    one = "_cp_one"
    out = running_totals(df.withColumn(one, F.lit(1).cast("long")), order, [one], by,
                         inclusive=False, prefix="_cp_idx_", num_blocks=num_blocks,
                         totals="_cp_all_" if size else None)
    if size:
        out = out.withColumnRenamed(f"_cp_all_{one}", size)
    return out.withColumnRenamed(f"_cp_idx_{one}", name).drop(one)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    by: Sequence[str] = (), num_blocks: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas/numpy default,
    DuckDB ``quantile_cont``) per ``by`` group; one output column per entry
    of ``probs`` (name -> probability). NULL and NaN values are skipped.

    The rows are first counted per (group, distinct value) - partial
    aggregation collapses repeated values map-side - then the position range
    of each distinct value is a prefix sum of those counts
    (``running_totals``), and the values at the needed positions are found
    by a range lookup against a table of (group x 2 x #probs) targets.
    No group's values are ever buffered in one task.
    """
    by = list(by)
    v = df.select(*by, F.col(value).cast("double").alias("_q_v"))
    v = v.where(F.col("_q_v").isNotNull() & ~F.isnan("_q_v"))
    # one row per (group, distinct value): the fact is read once, into this stage
    distinct = stage(v.groupBy(*by, "_q_v").agg(F.count(F.lit(1)).alias("_q_c")), "values")
    cum = running_totals(distinct, ["_q_v"], ["_q_c"], by, inclusive=True, prefix="_cum",
                         num_blocks=num_blocks)
    # rows [_cum_q_c - _q_c, _cum_q_c) hold this value
    counts = distinct.groupBy(*by).agg(F.sum("_q_c").alias("_q_n"))
    specs = F.array(*[F.struct(F.lit(k).alias("qname"), F.lit(float(p)).alias("p"))
                      for k, p in probs.items()])
    targets = (counts.select(*by, "_q_n", F.explode(specs).alias("s"))
               .select(*by, "s.qname", (F.col("s.p") * (F.col("_q_n") - 1)).alias("h"))
               .select(*by, "qname", "h",
                       F.floor("h").cast("long").alias("lo"),
                       F.ceil("h").cast("long").alias("hi")))
    ends = (targets.select(*by, "qname", F.lit("lo").alias("end"), F.col("lo").alias("_q_pos"))
            .union(targets.select(*by, "qname", F.lit("hi").alias("end"), F.col("hi").alias("_q_pos"))))

    def covers(pos):
        return (F.col("_cum_q_c") - F.col("_q_c") <= pos) & (pos < F.col("_cum_q_c"))

    if not by:
        # No group key: the target positions are scalars. They are projected
        # as columns and read by conditional aggregates - no join at all.
        n = counts.select("_q_n").scalar()
        pos = cum
        for k, p in probs.items():
            h = F.lit(float(p)) * (n - 1)
            pos = (pos.withColumn(f"_h_{k}", h).withColumn(f"_lo_{k}", F.floor(h))
                      .withColumn(f"_hi_{k}", F.ceil(h)))
        aggs = []
        for k in probs:
            aggs += [F.max(F.when(covers(F.col(f"_lo_{k}")), F.col("_q_v"))).alias(f"{k}__lo"),
                     F.max(F.when(covers(F.col(f"_hi_{k}")), F.col("_q_v"))).alias(f"{k}__hi"),
                     F.max(F.col(f"_h_{k}") - F.col(f"_lo_{k}")).alias(f"{k}__f")]
        row = pos.agg(*aggs)
        st = row.select(F.struct(*[F.col(c) for c in row.columns]).alias("s")).select("s").scalar()
        out = []
        for k in probs:
            lo, hi, fr = st.getField(f"{k}__lo"), st.getField(f"{k}__hi"), st.getField(f"{k}__f")
            out.append((lo + (hi - lo) * fr).alias(k))
        return df.sparkSession.range(1).select(*out)
    found = null_safe_join(cum, ends, by).where(covers(F.col("_q_pos")))
    vals = found.groupBy(*by, "qname").agg(
        F.max(F.when(F.col("end") == "lo", F.col("_q_v"))).alias("v_lo"),
        F.max(F.when(F.col("end") == "hi", F.col("_q_v"))).alias("v_hi"))
    res = (null_safe_join(targets, vals, [*by, "qname"])
           .select(*by, "qname",
                   (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("h") - F.col("lo")))
                   .alias("q")))
    return res.groupBy(*by).pivot("qname", list(probs)).agg(F.first("q"))


def global_quantile(df: DataFrame, value: str, p: float) -> Column:
    """A scalar-subquery column holding one exact quantile of ``value``."""
    return exact_quantiles(df, value, {"_gq": p}).select("_gq").scalar()


def fill_with_group_median(df: DataFrame, cols: Sequence[str], by: Sequence[str],
                           global_fallback: bool = True) -> DataFrame:
    """Fill missing values with the group median, then with the global
    median of the group-filled column (the reference's order of operations).

    All columns go through one long (group, column, value) table, so there
    are two exact-quantile passes whatever the number of columns: one per
    (group, column) and one per column for the fallback. The median tables
    have one row per group / per column and are joined back.
    """
    by, cols = list(by), list(cols)
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val"))
                             for c in cols])).alias("_kv")
    long = df.select(*by, kv).select(*by, "_kv._col", "_kv._val")
    # one row per (group, column): tiny, so it is checkpointed to keep the
    # fallback pass below from re-planning the first one
    gmed = materialize(exact_quantiles(long, "_val", {"_gmed": 0.5}, by=[*by, "_col"]))
    wide = gmed.groupBy(*by).pivot("_col", cols).agg(F.first("_gmed"))
    wide = wide.select(*by, *[F.col(c).alias(f"_gm_{c}") for c in cols])
    out = df.join(wide, on=by, how="left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_gm_{c}").cast(df.schema[c].dataType)))
    out = out.drop(*[f"_gm_{c}" for c in cols])
    # The fallback can only change missing values whose (group, column) has
    # no median (all values missing, so the group is absent from the tiny
    # median table) or whose group key is missing; one anti-join against
    # that table tells whether any exist (NULL keys never match, so they count
    # too), and the second exact-quantile pass
    # is skipped when it would be a no-op.
    missing = long.where(F.col("_val").isNull())
    unfilled = missing.join(gmed.where(F.col("_gmed").isNotNull()), on=[*by, "_col"], how="left_anti")
    if global_fallback and unfilled.limit(1).count() > 0:
        filled = (long.join(gmed, on=[*by, "_col"], how="left")
                      .select("_col", F.coalesce("_val", "_gmed").alias("_val")))
        glob = exact_quantiles(filled, "_val", {"_glob": 0.5}, by=["_col"])
        st = glob.groupBy().pivot("_col", cols).agg(F.first("_glob"))
        s_ = st.select(F.struct(*[F.col(c) for c in cols]).alias("s")).select("s").scalar()
        for c in cols:
            out = out.withColumn(c, F.coalesce(F.col(c), s_.getField(c).cast(df.schema[c].dataType)))
    return out
