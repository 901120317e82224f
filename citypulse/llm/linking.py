"""From band buckets to classes, without all pairs of a bucket.

1. Every member of a bucket is paired with one member of it, drawn by a hash,
   and the pair is verified exactly: linear in the bucket.
2. Verified pairs give components. Where a bucket's members fall in several
   components, a bucket of at most ``FEW`` members (``OUTLINED`` where sets have
   outlines), whose pairs are bounded, has its pairs of different components verified; a larger one is drawn again, over
   pairs of different components only, for as long as a draw still merges a
   notable share of them.
3. What still mixes components is joined exactly: tokens are ordered from rare
   to frequent, and two sets whose similarity reaches the threshold must share
   one of their first few tokens at places that leave room for the overlap
   (prefix and positional filter). Pairs of one component are never formed.

So no link between two components is lost, a bucket full of copies costs its
size and not its square, and a family of texts that are alike but below the
threshold is told apart by the rare tokens that make its members differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.components import components
from citypulse.llm.stage import released, remove, scratch

FEW = 8  # members of a bucket whose pairs are verified directly
# The same where outlines tell most pairs apart inside the join: what a member then
# costs at most, a few thousand words compared, is less than one pair verified.
OUTLINED = 8192
FINE = 32  # longs of the outlines that pairs of such buckets get before their sets move; a power of two
Features = Callable[[DataFrame], DataFrame]
# ``s`` as an array of distinct tokens: (frame, columns) -> frame
Tokens = Callable[[DataFrame, list[str]], DataFrame]


def _mask(draw: int) -> Column:
    """A number per bucket; the least id xor this number is a random member."""
    return F.xxhash64("bucket", F.lit(draw))


def _drawn(buckets: DataFrame, draw: int, *extra: Column) -> DataFrame:
    """(bucket, hub, ...) with the member that this draw picks."""
    groups = buckets.groupBy("bucket").agg(F.min(F.col("id").bitwiseXOR(_mask(draw))).alias("hub"), *extra)
    return groups.withColumn("hub", F.col("hub").bitwiseXOR(_mask(draw)))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _as_they_are(df: DataFrame, columns: list[str]) -> DataFrame:
    return df


def link(buckets: DataFrame, features: Features, threshold: float, merging: float = 0.1,
         tokens: Tokens = _as_they_are, outlines: Features | None = None,
         spent: Callable[[], None] | None = None) -> DataFrame:
    """``buckets`` (bucket, id) -> (id, root) of every linked id, roots included.
    ``features`` takes ids and returns (id, s): their token sets, or something
    smaller to move that ``tokens`` makes into sets where a pair meets. ``outlines``
    takes these and returns (id, n, b0, b1, ...), see ``_near``. Draws go on
    while one links more than the share ``merging`` of the members that are
    left; the result does not depend on it, only what the exact join is left
    with. ``spent`` is called once ``buckets`` is not read any more."""
    # nearly every bucket has one member, so combining before the shuffle gains
    # nothing: one shuffle by bucket serves both the draw and the join
    buckets = buckets.repartition("bucket")
    groups = _drawn(buckets, 0, F.count(F.lit(1)).alias("n")).where("n > 1")
    with scratch() as drawn:
        members = released(buckets.join(groups, "bucket"), "members")
    if spent:
        spent()
    sets = released(features(members.select("id").distinct()), "sets")

    marks = released(outlines(sets), "outlines") if outlines else None

    def verified(pairs: DataFrame, near: bool = False) -> DataFrame:
        if marks is not None:
            pairs = _nearer(pairs, sets, threshold, tokens) if near else _near(pairs, marks, threshold)
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
        # each step is a projection of its own, so nothing is evaluated twice; the
        # verdict is written with its pair, for a filter would be pushed below them
        both = tokens(both, ["sa", "sb"]).select(
            "a", "b", F.size(F.array_intersect("sa", "sb")).alias("common"), (F.size("sa") + F.size("sb")).alias("n"))
        alike = both.select("a", "b", (F.col("common") >= threshold * (F.col("n") - F.col("common"))).alias("alike"))
        return released(alike, "links").where("alike").select("a", "b")

    links = verified(members.where("id != hub").select(*_pair("id", "hub")).distinct())
    roots = components(links)
    # a bucket of two has no pair left; one of a few members has a few pairs
    mixed = released(_mixed(members.where("n > 2").select("bucket", "id", "n"), roots), "mixed")
    remove(members.sparkSession, drawn)
    bound = FEW if marks is None else OUTLINED
    few = mixed.where(F.col("n") <= bound).drop("n")
    if marks is None:
        other = few.select("bucket", F.col("id").alias("b"), F.col("root").alias("b_root"))
        pairs = few.join(other, "bucket").where("id < b and root != b_root").select(F.col("id").alias("a"), "b").distinct()
    else:
        pairs = released(_near_mates(few, marks, threshold), "near")
    found = verified(pairs, near=True)
    if not found.isEmpty():
        roots = _merged(roots, found)
    mixed, more, draw = mixed.where(F.col("n") > bound), True, 0
    while True:
        mixed = released(_mixed(mixed.select("bucket", "id"), roots), "mixed")
        if more:
            draw += 1
            rooted = mixed.join(_drawn(mixed, draw), "bucket")
            hub_roots = mixed.select("bucket", F.col("id").alias("hub"), F.col("root").alias("hub_root"))
            pairs = rooted.join(hub_roots, ["bucket", "hub"]).where("root != hub_root").select(
                *_pair("id", "hub")).distinct()
        else:
            pairs = _rare_pairs(mixed.select("id", "root").distinct(), sets, threshold, tokens)
        found = verified(pairs)
        n = found.count()
        if n:
            roots = _merged(roots, found)
        if not more:
            break
        more = n > merging * mixed.count()
    own = roots.select(F.col("root").alias("id")).distinct().withColumn("root", F.col("id"))
    return roots.unionByName(own)


def _near(pairs: DataFrame, marks: DataFrame, t: float) -> DataFrame:
    """The pairs that their outlines let reach similarity ``t``. An outline has a
    bit set for every token's hash, so each bit in which two of them differ stands
    for at least one token of one side alone, and at similarity t no more than
    (1 - t) / (1 + t) of both sizes are such tokens; ``n`` is at least the size.
    No pair that reaches ``t`` goes. The same holds of any words of an outline:
    half of them move with every pair, all of them with the pairs that remain."""
    words = [c for c in _outline(marks) if c != "n"]
    for part in (words[:len(words) // 2], words):
        seen = marks.select("id", "n", *part)
        both = pairs.join(_side(seen, "a"), "a").join(_side(seen, "b"), "b")
        pairs = released(both.where(_reach(seen, t)).select("a", "b"), "near")
    return pairs


def _nearer(pairs: DataFrame, sets: DataFrame, t: float, tokens: Tokens) -> DataFrame:
    """``_near`` with longer outlines and exact sizes, made of the sets that are still
    in some pair. Large sets fill a short outline, and where tokens repeat the size
    it bounds is far above the set's; a set meets many such pairs, and is cut into
    tokens once here instead of once for each."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # the outer form: an emptiness filter pushed down would cut texts again for each token
    found = tokens(sets.join(ends, "id"), ["s"]).select("id", F.explode_outer("s").alias("s"))
    bit = F.expr("shiftleft(1L, cast(s & 63 as int))")
    word = F.shiftright("s", 6).bitwiseAND(F.lit(FINE - 1))
    fine = found.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[
        F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"b{k}") for k in range(FINE)])
    return _near(pairs, released(fine, "fine"), t)


def _near_mates(members: DataFrame, marks: DataFrame, t: float) -> DataFrame:
    """As ``_near``, of the pairs of one bucket and two roots; only those that
    remain leave the join."""
    outlined = members.join(marks, "id").withColumnRenamed("id", "a")
    x = _side(outlined.withColumnsRenamed({"a": "id", "root": "a_root"}), "a")
    y = _side(outlined.withColumnsRenamed({"a": "id", "root": "b_root"}), "b")
    return x.join(y, "bucket").where((F.col("a") < F.col("b")) & (F.col("a_root") != F.col("b_root")) & _reach(marks, t)).select(
        "a", "b").distinct()


def _outline(marks: DataFrame) -> list[str]:
    return [c for c in marks.columns if c != "id"]


def _side(df: DataFrame, end: str) -> DataFrame:
    return df.withColumnsRenamed({"id": end} | {c: f"{end}_{c}" for c in df.columns if c == "n" or c[0] == "b" and c[1:].isdigit()})


def _reach(marks: DataFrame, t: float) -> Column:
    words = [c for c in _outline(marks) if c != "n"]
    apart = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in words), F.lit(0))
    return apart * (1 + t) <= (F.col("a_n") + F.col("b_n")) * (1 - t) + 1e-6


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their roots."""
    rooted = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rooted.join(several.where("low < high").select("bucket"), "bucket")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links, which join whole components."""
    at = lambda c: roots.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))
    ends = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    higher = released(components(ends), "roots").select(F.col("id").alias("root"), F.col("root").alias("top"))
    moved = roots.join(higher, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    return released(moved.unionByName(higher.select(F.col("root").alias("id"), F.col("top").alias("root"))), "roots")


def _rare_pairs(nodes: DataFrame, sets: DataFrame, t: float, tokens: Tokens) -> DataFrame:
    """(a, b) of different roots that can reach similarity ``t``."""
    found = tokens(sets.join(nodes, "id"), ["s"]).select("id", "root", F.size("s").alias("n"), F.explode("s").alias("token"))
    found = released(found, "tokens")
    often = found.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    ranked = found.join(often, "token").groupBy("id", "root", "n").agg(
        F.sort_array(F.collect_list(F.struct("often", "token"))).alias("order"))
    first = F.col("n") - F.ceil(F.col("n") * t) + 1
    head = ranked.select("id", "root", "n", F.posexplode(F.slice("order", F.lit(1), first)).alias("at", "x")).where(
        "x.often > 1").select("id", "root", "n", "at", F.col("x.token").alias("token"))
    head = released(head, "heads")
    x = head.select("token", *[F.col(c).alias(f"x_{c}") for c in ("id", "root", "n", "at")])
    y = head.select("token", *[F.col(c).alias(f"y_{c}") for c in ("id", "root", "n", "at")])
    need = F.ceil((F.col("x_n") + F.col("y_n")) * F.lit(round(t / (1 + t) - 1e-9, 9)))
    room = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    on = ((x["token"] == y["token"]) & (F.col("x_id") < F.col("y_id")) & (F.col("x_root") != F.col("y_root"))
          & (room >= need))
    return x.join(y, on).select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()
