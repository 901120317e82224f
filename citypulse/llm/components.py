"""Connected components over distributed links (DataFrame operations only).

Alternating large-star and small-star rounds point every node at the least
node of its neighbourhood until the links form stars; the number of rounds is
logarithmic in the number of nodes. Each round's links are a checkpoint in the
shared folder. Neither links nor components ever reach the driver, only a
count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.operators.materialize import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:  # every greater neighbour of a node moves to its least neighbour
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # every lesser neighbour of a node, and the node, move to the least of them
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (id, root) for every linked node; root is the least
    id of its component. Unlinked nodes are absent; null ends are ignored."""
    now = materialize(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct())
    mark = None
    while True:
        new = _mark(now)
        if new == mark:
            break
        mark = new
        now = materialize(_star(_star(now, True), False))
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
