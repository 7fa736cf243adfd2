"""Segments by density: DBSCAN on a grid."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.graph import connected
from shoplens.scratch import materialize

#: A cell is divided into so many parts a side; a part enters comparisons as one box.
PARTS = 8


def _farthest(p_low: str, p_high: str, low: str, high: str) -> Column:
    """Squared distance between the farthest points of two boxes."""
    return F.expr(
        f"aggregate(zip_with(zip_with({p_low}, {high}, (p, h) -> h - p), zip_with({p_high}, {low}, (p, l) -> p - l), "
        "(u, v) -> greatest(u, v) * greatest(u, v)), 0D, (s, x) -> s + x)"
    )


def _nearest(p_low: str, p_high: str, low: str, high: str) -> Column:
    """Squared distance between the nearest points of two boxes."""
    return F.expr(
        f"aggregate(zip_with(zip_with({p_low}, {high}, (p, h) -> p - h), zip_with({p_high}, {low}, (p, l) -> l - p), "
        "(u, v) -> greatest(u, v, 0D) * greatest(u, v, 0D)), 0D, (s, x) -> s + x)"
    )


def _within() -> Column:
    """Whether two points are at most 1 apart."""
    return F.expr("aggregate(zip_with(x, other_x, (p, q) -> (p - q) * (p - q)), 0D, (s, d) -> s + d) <= 1")


def _around(cell: str, d: int) -> Column:
    """The cells that may hold points within reach of a cell's, itself included."""
    reach = ceil(sqrt(d))
    steps = [F.transform(F.arrays_zip(F.col(cell).alias("c"), F.array(*map(F.lit, step)).alias("s")), lambda z: z["c"] + z["s"]) for step in product(range(-reach, reach + 1), repeat=d)]
    return F.explode(F.array(*steps))


def _boxes(points: DataFrame, d: int) -> DataFrame:
    """One row for each part of a cell that holds points: weight and bounds."""
    low = F.array(*[F.min(F.col("x")[i]) for i in range(d)])
    high = F.array(*[F.max(F.col("x")[i]) for i in range(d)])
    return points.groupBy("cell", "part").agg(F.sum("w").alias("box_w"), low.alias("low"), high.alias("high"))


def dbscan(df: DataFrame, key: str, cols: Sequence[str], eps: float, min_points: int) -> DataFrame:
    """``df``'s key with its segment (the least key of the segment's core points; NULL for noise) and whether it is a core point.

    Core points have ``min_points`` rows within ``eps``, themselves included; core points within eps of each other share a
    segment, and another point within eps of core points belongs to the segment of the least number among theirs. Rows
    without a key, or without a number in every column, are left out. Meant for two or three columns.

    Equal points are one row with a weight. Cells have a diagonal of eps, so a cell of min_points is all core and one
    segment, and only points of cells with fewer are counted one by one. They are held against boxes around the parts of the
    cells about them, of which most are wholly near or wholly far; only of the few between are the points
    looked at. Cells join by their boxes likewise, and only where no two boxes are wholly near do points meet: two dense boxes just
    about eps apart, in cells that nothing else joins, are the one place where points meet pairwise.
    """
    d = len(cols)
    side = 1 / sqrt(d) * (1 - 1e-9)  # no two points of a cell are farther apart than 1, rounding or not
    values = [F.col(c).cast("double") / eps for c in cols]
    sound = F.col(key).isNotNull()
    for c in cols:
        sound = sound & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = materialize(df.where(sound).select(F.col(key).alias("key"), F.array(*values).alias("x")), "density-rows")
    points = rows.groupBy("x").agg(F.count("*").alias("w"), F.min("key").alias("least"))
    cell = F.transform("x", lambda v: F.floor(v / side))
    part = F.transform("x", lambda v: F.floor(v * PARTS / side))
    points = materialize(points.withColumns({"id": F.monotonically_increasing_id(), "cell": cell, "part": part}), "density-points")
    boxes = materialize(_boxes(points, d), "density-boxes")
    crowded = points.groupBy("cell").agg(F.sum("w").alias("cell_w"))
    points = materialize(points.join(crowded, "cell"), "density-cells")
    sparse = points.where(F.col("cell_w") < min_points).select("id", "x", "cell")

    # Rows within reach of the points of sparse cells.
    counted = _near_boxes(sparse, boxes, points, d).groupBy("id").agg(F.sum("near_w").alias("near_w"))
    core_few = counted.where(F.col("near_w") >= min_points).select("id")
    core_id = points.where(F.col("cell_w") >= min_points).select("id").union(core_few)
    core = materialize(points.join(core_id, "id"), "density-core")

    # Cells whose core points reach one another.
    core_boxes = materialize(_boxes(core, d), "density-core-boxes")
    a = core_boxes.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), _around("cell", d).alias("cell"))
    met = a.join(core_boxes, "cell").where("cell_a < cell").withColumn("sure", _farthest("low_a", "high_a", "low", "high") <= 1)
    met = met.where(_nearest("low_a", "high_a", "low", "high") <= 1).select("cell_a", "cell", "part_a", "part", "sure")
    met = materialize(met, "density-box-pairs")
    sure = met.where("sure").select("cell_a", "cell").distinct()
    open_ = met.join(sure, ["cell_a", "cell"], "left_anti")
    left = core.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), "x")
    right = core.select("cell", "part", F.col("x").alias("other_x"))
    touching = open_.join(left, ["cell_a", "part_a"]).join(right, ["cell", "part"]).where(_within()).select("cell_a", "cell").distinct()
    edges = sure.union(touching).select(_name("cell_a").alias("a"), _name("cell").alias("b"))
    labels = connected(core.select(_name("cell").alias("node")), edges)
    core = core.withColumn("node", _name("cell")).join(labels, "node")
    names = core.groupBy("label").agg(F.min("least").alias("segment"))
    core = materialize(core.join(names, "label").select("id", "x", "cell", "part", "w", "segment"), "density-segments")

    # The other points, by the core boxes about them; each cell's core points are of one segment.
    rest = sparse.join(core.select("id"), "id", "left_anti")
    of_cell = core.groupBy("cell").agg(F.min("segment").alias("near_segment"))
    touched = _near_boxes(rest, core_boxes, core, d).where("near_w > 0").join(of_cell.withColumnRenamed("cell", "near_cell"), "near_cell")
    border = touched.groupBy("id").agg(F.min("near_segment").alias("segment"))
    found = core.select("id", "segment", F.lit(True).alias("is_core")).unionByName(border.withColumn("is_core", F.lit(False)))
    named = points.select("id", "x").join(materialize(found, "density-found"), "id", "left")
    named = named.select("x", "segment", F.coalesce("is_core", F.lit(False)).alias("is_core"))
    return rows.join(materialize(named, "density-named"), "x").select(F.col("key").alias(key), "segment", "is_core")


def _name(cell: str) -> Column:
    return F.array_join(F.transform(cell, lambda c: c.cast("string")), ",")


def _near_boxes(some: DataFrame, boxes: DataFrame, points: DataFrame, d: int) -> DataFrame:
    """id, x, cell of some points -> id, near_cell, near_w: the weight within 1 of each, by cells about it."""
    about = some.select("id", "x", _around("cell", d).alias("cell")).join(boxes, "cell")
    near = _nearest("x", "x", "low", "high") <= 1
    about = materialize(about.where(near).withColumn("sure", _farthest("x", "x", "low", "high") <= 1), "density-about")
    whole = about.where("sure").select("id", F.col("cell").alias("near_cell"), F.col("box_w").alias("near_w"))
    each = points.select("cell", "part", F.col("x").alias("other_x"), "w")
    partly = about.where("NOT sure").select("id", "x", "cell", "part").join(each, ["cell", "part"]).where(_within())
    return whole.union(partly.select("id", "cell", "w"))
