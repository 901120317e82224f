"""DBSCAN over a graph of cells.

Equal points are one spot with a weight. Cells have the side eps / sqrt(d), so
all points of a cell are neighbours: a cell of ``min_samples`` points consists
of core points, and only points of thinner cells, fewer than ``min_samples`` in
each, have their neighbours counted. Cells are joined instead of points: two
cells are linked when some core points of theirs lie within eps. That is
decided on boxes, the bounds of their core points: boxes that lie within eps as
a whole (or whose representative points do) link the cells, boxes farther apart
don't, and undecided pairs are halved in every dimension, level by level; only
what is left after ``LEVELS`` halvings is compared point by point. Clusters are
the connected components of cells, so a cell with a third of all rows adds work
in proportion to its rows and never pairs within it.

Core points carry the cluster of their cell, border points take the least
cluster that reaches them, noise is -1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.operators.materialize import stage

LEVELS = 5


def dbscan(df: DataFrame, cols: Sequence[str], key: str, eps: float = 1.5, min_samples: int = 2,
           grid_cols: int = 2) -> DataFrame:
    """(key, dbscan_label). Neighbouring cells are found through a coarse grid on
    ``grid_cols`` of the columns; all of them make the distance. Rows with a
    missing column are noise. Labels number the clusters by their least core
    key."""
    cols = list(cols)
    side = eps / math.sqrt(len(cols)) * (1 - 1e-9)
    points = stage(df.select(F.col(key).cast("long").alias("id"), F.array(
        *[F.col(c).cast("double") + F.lit(0.0) for c in cols]).alias("x")), "points")
    whole = points.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    spots = whole.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    spots = stage(spots.withColumn("cell", F.xxhash64(_grid("x", side))), "spots")
    cells = stage(spots.groupBy("cell").agg(F.sum("n").alias("n"), *_bounds(len(cols))), "cells")
    near = stage(_near(cells, eps, min(grid_cols, len(cols))), "near-cells")

    # points of thin cells: their own cell and what lies within eps in the cells around
    thin = spots.join(cells.where(F.col("n") < min_samples).select("cell", F.col("n").alias("own")), "cell")
    around = _within(thin, near, spots, eps).groupBy("id").agg(F.sum("other_n").alias("around"))
    counted = thin.join(around, "id", "left").withColumn(
        "core", F.col("own") + F.coalesce("around", F.lit(0)) >= min_samples)
    thin = stage(counted.select("id", "x", "cell", "core"), "thin")
    dense = spots.join(cells.where(F.col("n") >= min_samples).select("cell"), "cell", "left_semi").select("id", "x", "cell")
    core = stage(dense.unionByName(thin.where("core").select("id", "x", "cell")), "core")

    nodes = core.select(F.col("cell").alias("a")).distinct()
    roots = _components(nodes, _links(core, near, eps, side, len(cols)))
    # clusters by their least core key
    named = core.join(roots.select(F.col("id").alias("cell"), "root"), "cell")
    least = named.groupBy("root").agg(F.min("id").alias("least"))
    from citypulse.operators.ordered import ordered_index
    numbers = stage(roots.join(least.join(ordered_index(least.select("least"), ["least"], name="label"), "least"), "root")
                    .select(F.col("id").alias("cell"), "label"), "clusters")
    cores = stage(core.join(numbers, "cell"), "labelled-core")
    border = thin.where("not core").select("id", "x", "cell")
    inside = border.join(cores.select("cell", "label"), "cell").select("id", "label")
    reach = _within(border, near, cores, eps, "label").select("id", F.col("other_label").alias("label"))
    borders = inside.unionByName(reach).groupBy("id").agg(F.min("label").alias("label"))
    labelled = cores.select("id", "label").unionByName(borders).join(spots.select("id", "x"), "id").select("x", "label")
    return points.join(labelled, "x", "left").select(
        F.col("id").alias(key), F.coalesce("label", F.lit(-1)).cast("int").alias("dbscan_label"))


def _grid(x: str, side: float) -> Column:
    return F.transform(x, lambda v: F.floor(v / side).cast("long"))


def _bounds(d: int) -> list[Column]:
    at = lambda i: F.element_at("x", i + 1)
    return [F.array(*[F.min(at(i)) for i in range(d)]).alias("lo"), F.array(*[F.max(at(i)) for i in range(d)]).alias("hi"),
            F.min("x").alias("some")]


def _square(gaps: Column) -> Column:
    return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)


def _distance(a: str, b: str) -> Column:
    return _square(F.zip_with(a, b, lambda u, v: u - v))


def _apart(p: str, q: str) -> Column:
    """Least squared distance of two boxes."""
    return _square(F.zip_with(F.zip_with(f"{p}lo", f"{q}hi", lambda u, v: u - v),
                              F.zip_with(f"{q}lo", f"{p}hi", lambda u, v: u - v),
                              lambda u, v: F.greatest(u, v, F.lit(0.0))))


def _across(p: str, q: str) -> Column:
    """Greatest squared distance of points in two boxes."""
    return _square(F.zip_with(F.zip_with(f"{p}hi", f"{q}lo", lambda u, v: u - v),
                              F.zip_with(f"{q}hi", f"{p}lo", lambda u, v: u - v), lambda u, v: F.greatest(u, v)))


def _near(cells: DataFrame, eps: float, grid: int) -> DataFrame:
    """(a, b) of different cells whose boxes lie within eps, both ways; a cell
    meets the 3**grid blocks around its own, of side 2 eps."""
    home = F.transform(F.slice("lo", 1, grid), lambda v: F.floor(v / (2 * eps)).cast("long"))
    steps = F.array(*[F.array(*[F.lit(s).cast("long") for s in d]) for d in product((-1, 0, 1), repeat=grid)])
    left = cells.select(F.col("cell").alias("a"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), home.alias("block"))
    right = cells.select(F.col("cell").alias("b"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"), home.alias("home"),
                         F.explode(steps).alias("step")).withColumn(
        "block", F.zip_with("home", "step", lambda u, v: u + v)).drop("home", "step")
    return left.join(right, "block").where((F.col("a") != F.col("b")) & (_apart("p_", "q_") <= eps * eps)).select("a", "b")


def _within(some: DataFrame, near: DataFrame, others: DataFrame, eps: float, take: str = "n") -> DataFrame:
    """(id, other_<take>) of ``others`` in cells around that lie within eps."""
    left = some.select("id", "x", F.col("cell").alias("a")).join(near, "a")
    right = others.select(F.col("cell").alias("b"), F.col("x").alias("y"), F.col(take).alias(f"other_{take}"))
    return left.join(right, "b").where(_distance("x", "y") <= eps * eps).select("id", f"other_{take}")


def _links(core: DataFrame, near: DataFrame, eps: float, side: float, d: int) -> DataFrame:
    """(a, b) of cells with core points within eps of each other."""
    square, linked = eps * eps, None
    held = core.select("cell").distinct()
    pairs = near.where("a < b").join(held.withColumnRenamed("cell", "a"), "a", "left_semi").join(
        held.withColumnRenamed("cell", "b"), "b", "left_semi")
    todo = pairs.select("a", "b", F.col("a").alias("sub_a"), F.col("b").alias("sub_b"))
    for level in range(LEVELS + 1):
        # level 0: the cell itself; then its parts, named by cell and place
        part = F.col("cell") if level == 0 else F.xxhash64("cell", _grid("x", side / 2 ** level))
        boxes = stage(core.groupBy(part.alias("sub")).agg(*_bounds(d)), "boxes")
        named = lambda p, s: boxes.select(F.col("sub").alias(s), *[F.col(c).alias(f"{p}{c}") for c in ("lo", "hi", "some")])
        met = todo.join(named("p_", "sub_a"), "sub_a").join(named("q_", "sub_b"), "sub_b")
        met = stage(met.where(_apart("p_", "q_") <= square).select(
            "a", "b", "sub_a", "sub_b", ((_across("p_", "q_") <= square) | (_distance("p_some", "q_some") <= square)).alias("yes")),
            "met")
        new = met.where("yes").select("a", "b").distinct()
        linked = stage(new if linked is None else linked.unionByName(new), "cell-links")
        open_ = met.join(linked, ["a", "b"], "left_anti").select("a", "b", "sub_a", "sub_b")
        if open_.isEmpty():
            return linked
        if level < LEVELS:
            below = stage(core.select(part.alias("sub"), F.xxhash64("cell", _grid("x", side / 2 ** (level + 1))).alias("kid"))
                          .distinct(), "parts")
            kids = lambda s: below.select(F.col("sub").alias(f"sub_{s}"), F.col("kid").alias(f"kid_{s}"))
            todo = stage(open_.join(kids("a"), "sub_a").join(kids("b"), "sub_b").select(
                "a", "b", F.col("kid_a").alias("sub_a"), F.col("kid_b").alias("sub_b")), "todo")
        else:
            at = lambda s, x: core.select(part.alias(f"sub_{s}"), F.col("x").alias(x))
            last = open_.join(at("a", "x"), "sub_a").join(at("b", "y"), "sub_b").where(_distance("x", "y") <= square)
            linked = linked.unionByName(last.select("a", "b").distinct())
    return linked


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, root): least cell reachable. Each round takes the least root
    among neighbours and then the root of that root, so paths halve."""
    both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    now = stage(nodes.select(F.col("a").alias("id"), F.col("a").alias("root")), "roots")
    while True:
        heard = both.join(now.select(F.col("id").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        step = now.join(heard, now.id == heard.a, "left").select("id", F.least("root", "m").alias("root"))
        jump = step.join(step.select(F.col("id").alias("root"), F.col("root").alias("up")), "root").select(
            "id", F.col("up").alias("root"))
        new = stage(jump, "roots")
        if new.join(now.withColumnRenamed("root", "old"), "id").where("root != old").isEmpty():
            return new
        now = new
