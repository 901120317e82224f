"""Train/test splits and folds.

Random assignments are a pure function of the row id and a seed, so a split
is identical after repartitioning, recomputation after an executor loss, and
in a later evaluation job (the reference re-draws the same seeded split in
``evaluate``). ``randomSplit`` depends on partition layout and is not used.

The hash mixes both halves of the id with xor-shift and multiply rounds and
the seed between the rounds, so seeds are independent of each other; it is
plain 62-bit integer arithmetic, so the same split can be written in SQL.
Positional operators (contiguous folds, first-80 % splits, stratified
ranks) go through ``ordered_index``: no global window in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.operators.ordered import ordered_index

_M = 2147483648  # 2**31
# odd multipliers below 2**31: a product of two 31-bit numbers fits in a long
_ROUNDS = (1103515245, 1540483477, 374761393)


def _seeds(seed: int) -> list[int]:
    """One 31-bit constant per round, far apart for neighbouring seeds."""
    return [(seed * 668265263 + (k + 1) * 1274126177) % _M for k in range(len(_ROUNDS))]


def hash_unit(id_col: str | Column, seed: int = 42) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from an integer id."""
    x = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("long")
    m = F.lit(_M).cast("long")
    h = F.pmod(x, m).bitwiseXOR(F.pmod(F.pmod(F.shiftright(x, 31), m) * _ROUNDS[1], m))
    for a, s in zip(_ROUNDS, _seeds(seed)):
        h = h.bitwiseXOR(F.lit(s).cast("long"))
        h = F.pmod(h.bitwiseXOR(F.shiftright(h, 15)) * a, m)
    return h.bitwiseXOR(F.shiftright(h, 13)) / F.lit(float(_M))


def hash_unit_sql(id_expr: str, seed: int = 42) -> str:
    """DuckDB text of ``hash_unit`` for non-negative ids."""
    x = f"CAST({id_expr} AS BIGINT)"
    h = f"xor({x} % {_M}, (({x} >> 31) % {_M}) * {_ROUNDS[1]} % {_M})"
    for a, s in zip(_ROUNDS, _seeds(seed)):
        h = f"xor({h}, {s})"
        h = f"(xor({h}, {h} >> 15) * {a} % {_M})"
    return f"(xor({h}, {h} >> 13) / {float(_M)})"


def random_split(df: DataFrame, id_col: str, test_frac: float = 0.2, seed: int = 42,
                 out: str = "is_test") -> DataFrame:
    """Seeded 80/20 split, reproducible from the id alone."""
    return df.withColumn(out, (hash_unit(id_col, seed) < test_frac).cast("int"))


def stratified_split(df: DataFrame, label: str, id_col: str, test_frac: float = 0.2,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """Per class, the ``round(test_frac * n_class)`` rows with the smallest
    hash go to test, so class shares are kept exactly; NULL labels are a class.
    When a class has a single row, stratifying is impossible and the whole
    split falls back to the seeded random one; ``split_mode`` says which was
    taken."""
    keyed = df.withColumn("_h", hash_unit(id_col, seed))
    counts = keyed.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    # a class may hold nearly all rows: its size comes with each block's offset, not by a join on the label
    idx = ordered_index(keyed, ["_h", id_col], by=[label], name="_p", size="_n")
    n_test = F.round(F.lit(test_frac) * F.col("_n"))
    fallback = counts.agg(F.min("_n").alias("m")).select("m").scalar() < 2
    return (idx.withColumn(out, F.when(fallback, F.col("_h") < test_frac)
                           .otherwise(F.col("_p") < n_test).cast("int"))
               .withColumn("split_mode", F.when(fallback, F.lit("random")).otherwise(F.lit("stratified")))
               .drop("_h", "_p", "_n"))


def kfold_of_position(pos: Column, n: Column, k: int) -> Column:
    """sklearn ``KFold``: contiguous folds, the first ``n % k`` one row bigger."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(
        r + F.floor((pos - big) / F.greatest(q, F.lit(1)))).cast("int")


def contiguous_kfold(df: DataFrame, order: list[str], k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled ``KFold(k)`` over the row order ``order``."""
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    idx = ordered_index(df, order, name="_p")
    return idx.withColumn(out, kfold_of_position(F.col("_p"), n, k)).drop("_p")


def stratified_kfold(df: DataFrame, label: str, id_col: str, k: int = 5, shuffle: bool = True,
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """Each class dealt round-robin over the folds along the (hashed or
    original) order, so every fold keeps the class shares."""
    order = ["_h", id_col] if shuffle else [id_col]
    keyed = df.withColumn("_h", hash_unit(id_col, seed))
    idx = ordered_index(keyed, order, by=[label], name="_p")
    return idx.withColumn(out, F.pmod(F.col("_p"), F.lit(k)).cast("int")).drop("_h", "_p")


def positional_split(df: DataFrame, order: list[str], train_frac: float = 0.8,
                     out: str = "is_test") -> DataFrame:
    """T4: first ``train_frac`` of the rows by position train, the rest test
    (pandas ``iloc[:int(n*0.8)]``)."""
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    idx = ordered_index(df, order, name="_p")
    return idx.withColumn(out, (F.col("_p") >= F.floor(n * train_frac)).cast("int")).drop("_p")


def tail_holdout(df: DataFrame, by: list[str], order: list[str], horizon: int,
                 fraction_divisor: int = 5, out: str = "is_holdout") -> DataFrame:
    """Last ``min(horizon, max(1, n // divisor))`` rows of each series.

    Series here are aggregates (one row per date), so the window partition is
    bounded by the calendar."""
    from pyspark.sql import Window
    w = Window.partitionBy(*by)
    wd = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    n = F.count(F.lit(1)).over(w)
    n_hold = F.least(F.lit(horizon), F.greatest(F.lit(1), F.floor(n / fraction_divisor)))
    return df.withColumn(out, (F.row_number().over(wd) <= n_hold).cast("int"))
