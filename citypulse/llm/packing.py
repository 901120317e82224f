"""Operator 8: variable-capacity best-fit packing.

Pieces of documents are packed into sequences of several permitted lengths.
Per block, pieces go in by decreasing length; each goes to the open bin with
the least room that holds it, and when none does, a bin of the permitted
length with the least cost opens. All lengths are optimised jointly: a length's
cost is weighed against what the pieces still to come can really put into it,
found by filling it greedily with them. At the end every bin is downsized to
the least permitted length that holds its contents.

Costs default to what a sequence costs a transformer: a linear part and one for
attention that grows with the square of the length, so long sequences only open
where shorter ones would be left too empty.

Blocks are formed by a hash of (document, length, copy, piece), so their size is
bounded by ``block_items`` in expectation whatever the sources look like; equal
rows are counted first and dealt by their copy number. Only (id, piece, length)
rows are shuffled, never texts.

Cases: null and empty texts have length 0 and get one piece of length 0 in no
bin (null bin columns); longer texts than the largest length are cut into
pieces that together cover the whole text; ties go to the shorter permitted
length and the lower piece key; rows of equal id and length are interchangeable
and each keeps pieces of its own; empty tables give an empty result; clashing
extra columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = ("doc_id long, piece long, start long, length long, bin_id string, "
       "bin_capacity long, bin_offset long")


def pack_block(lengths: Sequence[int], capacities: Sequence[int], costs: Sequence[float], ahead: bool = False
               ) -> tuple[list[int], list[int], list[int]]:
    """Best-fit of ``lengths`` (already in packing order): for each item its
    bin number and offset, and the final capacity of each bin. A bin that opens
    is priced by the total of the pieces to come, as if they fitted without gaps;
    ``ahead`` prices it by those that really go in.

    ``rooms`` keeps the distinct amounts of free room in order, each with the
    bins that have it (last opened first), so one item costs a binary search.
    """
    caps = sorted(range(len(capacities)), key=lambda i: capacities[i])
    size = [capacities[i] for i in caps]
    price = [costs[i] for i in caps]
    down = [-n for n in lengths]  # ascending

    def filled(room: int, at: int) -> int:
        """What the pieces from ``at`` on can put into ``room``, longest first."""
        total = 0
        while room > 0:
            at = bisect.bisect_left(down, -room, at)
            if at == len(down):
                break
            total += lengths[at]
            room -= lengths[at]
            at += 1
        return total

    rooms: list[int] = []
    by_room: dict[int, list[int]] = {}
    used: list[int] = []
    room_of: list[int] = []
    where, offset = [], []
    left = sum(lengths)
    for k, n in enumerate(lengths):
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            bins = by_room[room]
            b = bins.pop()
            if not bins:
                del by_room[room]
                rooms.pop(at)
        else:
            fit = [i for i in range(len(size)) if size[i] >= n]
            if ahead:
                # least cost per token that the pieces to come leave in it, at the
                # length that it would be downsized to
                load = {i: n + filled(size[i] - n, k + 1) for i in fit}
                each = {i: price[bisect.bisect_left(size, load[i])] / load[i] for i in fit}
            else:
                each = {i: price[i] / min(size[i], left) for i in fit}
            i = min(fit, key=lambda i: (each[i], size[i]))
            b, room = len(used), size[i]
            used.append(0)
            room_of.append(room)
        where.append(b)
        offset.append(used[b])
        used[b] += n
        left -= n
        room -= n
        if room > 0:
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append(b)
    final = [size[bisect.bisect_left(size, u)] for u in used]
    return where, offset, final


def pack(df: DataFrame, capacities: Sequence[int] = (1024, 2048, 4096, 8192),
         costs: Sequence[float] | None = None, length=None, id_col: str = "doc_id",
         text_col: str = "text", block_items: int = 50_000) -> DataFrame:
    """One row per piece with its bin. ``length`` is a Column of token counts
    (default: UTF-8 bytes, the exact count of a byte-level model); ``costs`` of
    the permitted lengths default to ``length * (1 + length / 16384)``."""
    capacities = list(capacities)
    costs = list(costs) if costs is not None else [c * (1 + c / 16384) for c in capacities]
    largest = max(capacities)
    length = length if length is not None else F.octet_length(F.col(text_col))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(length, F.lit(0)).cast("long").alias("n"))
    # how many pieces there are fixes the number of blocks; a column-pruned pass
    total = docs.select(F.sum(F.greatest(F.ceil(F.col("n") / largest), F.lit(1)))).first()[0] or 0
    blocks = max(1, int(-(-total // block_items)))
    # equal rows get copy numbers, in two steps so that no list is long
    per = docs.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("copies"))
    tens = per.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / 1000))))
    upto = F.least(F.lit(1000).cast("long"), F.col("copies") - F.col("k") * 1000)
    docs = tens.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), upto - 1))).select(
        "doc_id", "n", (F.col("k") * 1000 + F.col("copy")).alias("copy"))
    # long texts are cut evenly enough that every piece fits the largest length
    pieces = (
        docs.withColumn("piece", F.explode(F.sequence(
            F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0)).cast("long"))))
        .select("doc_id", "copy", "piece", (F.col("piece") * largest).alias("start"),
                F.least(F.lit(largest).cast("long"), F.col("n") - F.col("piece") * largest).alias("length"))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "length", "copy", "piece"), F.lit(blocks)))
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        pdf = pdf.sort_values(["length", "doc_id", "piece", "copy"], ascending=[False, True, True, True], kind="stable")
        full = pdf["length"] > 0
        where, offset, final = pack_block(pdf.loc[full, "length"].tolist(), capacities, costs, ahead=True)
        out = pdf[["doc_id", "piece", "start", "length"]].copy()
        out["bin_id"] = None
        out["bin_capacity"] = pd.array([None] * len(out), dtype="Int64")
        out["bin_offset"] = pd.array([None] * len(out), dtype="Int64")
        out.loc[full, "bin_id"] = [f"{block}-{w}" for w in where]
        out.loc[full, "bin_capacity"] = pd.array([final[w] for w in where], dtype="Int64")
        out.loc[full, "bin_offset"] = pd.array(offset, dtype="Int64")
        return out

    return pieces.groupBy("block").applyInPandas(run, OUT)
