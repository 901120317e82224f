"""Integer vectors of an embedding table, shared by operators 12 and 13."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
# Integer components lie within +-2**26 (values within +-2**18), so that squared
# distances of vectors of up to 512 dimensions stay exact in 64 bits; a value
# beyond is taken as the bound.
LIMIT = 2 ** 26


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, *more: str) -> tuple[DataFrame, int]:
    """(vec_id, x, *more) of the rows whose vector holds finite numbers only,
    x = floor(256 * component), and the dimension. Where lengths differ, the
    most frequent one counts (ties: the greater) and other rows are left out,
    like vectors without components."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bound = float(LIMIT)
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(bound)), F.lit(-bound))))
    rows = df.where(fine & (F.size(v) > 0)).select(
        F.col(id_col).cast("long").alias("vec_id"), x.cast("array<long>").alias("x"),
        *[F.col(c).alias(f"more_{c}") for c in more])
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    return rows.where(F.size("x") == size), size


def matrix(col: pa.Array, size: int) -> np.ndarray:
    """The lists of an Arrow column as rows of one integer matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
