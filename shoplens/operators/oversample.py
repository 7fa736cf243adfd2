"""Over-sampling of small classes by interpolation between neighbours (SMOTE)."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.functions.columns import hash_unit
from shoplens.scratch import materialize

#: Neighbours that a row is interpolated with, and rows of a bucket that are compared.
NEIGHBOURS, GROUP = 5, 64
#: Sets of buckets, each with its own directions; directions of a set; cells to a standard deviation.
TABLES, DIRECTIONS, CELLS = 4, 2, 4.0
#: Slices of the hash range in which rows are counted before they are numbered.
SLICES = 4_096


def numbered(df: DataFrame, place: Column, by: Sequence[str], tie: str, out: str = "rank") -> DataFrame:
    """``df`` with each row's number, from 0, in the order of ``place`` (0 to 1) and ``tie`` within its group.

    In two levels: sizes of slices are summed up, then rows are numbered within their slice, so no group is in one task.
    """
    placed = df.withColumns({"_place": place, "_slice": F.floor(place * SLICES).cast("int")})
    sizes = placed.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*by, "_slice", F.coalesce(before, F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy("_place", tie))
    return placed.join(starts, [*by, "_slice"]).withColumn(out, F.col("_start") + within - 1).drop("_place", "_slice", "_start")


def allotted(df: DataFrame, label: str, key: str, cols: Sequence[str], classes: Sequence[str], seed: int = 13) -> DataFrame:
    """The usable rows of ``classes`` with ``copies``, how many synthetic rows each is to seed.

    What a class lacks of the largest one is dealt evenly, the remainder by a hash of the key, so that class
    sizes come out equal to the row. Usable rows have a key and a number in every one of ``cols``; the others count
    as members of their class but seed nothing, and a class without usable rows stays as it is.
    """
    sound = F.col(key).isNotNull()
    for c in cols:
        sound = sound & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    members = df.where(F.col(label).isin(*classes))
    sizes = members.groupBy(label).agg(F.count("*").alias("_size"), F.count_if(sound).alias("_usable"))
    largest = sizes.agg(F.max("_size")).scalar()
    sizes = sizes.withColumn("_most", largest).withColumn("_lack", F.col("_most") - F.col("_size"))
    # As many rows as there are classes.
    dealt = members.where(sound).join(F.broadcast(sizes.select(label, "_usable", "_lack").where("_usable > 0")), label)
    small = dealt.where("_lack > 0")
    ranked = numbered(small, hash_unit(key, seed=seed), [label], key)
    more = F.when(F.col("rank") < F.col("_lack") % F.col("_usable"), 1).otherwise(0)
    return ranked.withColumn("copies", F.floor(F.col("_lack") / F.col("_usable")) + more).drop("rank", "_lack", "_usable")


def neighbours(rows: DataFrame, label: str, key: str, cols: Sequence[str], k: int = NEIGHBOURS, seed: int = 13) -> DataFrame:
    """key and near (up to k structs of distance, key, x), the nearest rows of its class that each row was held against.

    Columns are scaled by their class's spread. Rows are filed by where they fall on some random directions, in several
    ways; a cell with more rows than ``GROUP`` is dealt by a hash, so a dense place makes many small groups and not one
    large. Within a group all distances are exact, and a row's nearest of all its groups are kept. So a neighbour is a
    real row of the class close by, if not always the closest.
    """
    spread = rows.groupBy(label).agg(*[F.stddev_pop(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(cols)])
    scaled = rows.join(F.broadcast(spread), label)
    z = [F.col(c).cast("double") / F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0) for i, c in enumerate(cols)]
    points = scaled.select(label, F.col(key).alias("_key"), F.array(*z).alias("_z"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    draw = random.Random(seed)
    cells = []
    for t in range(TABLES):
        places = []
        for _ in range(DIRECTIONS):
            raw = [draw.gauss(0, 1) for _ in cols]
            length, shift = math.hypot(*raw), draw.random()
            along = sum((F.col("_z")[i] * (r / length) for i, r in enumerate(raw)), F.lit(0.0))
            places.append(F.floor(along * CELLS + shift))
        cells.append(F.struct(F.lit(t).alias("t"), F.array(*places).alias("at")))
    filed = materialize(points.withColumn("cell", F.explode(F.array(*cells))), "smote-cells")
    sizes = filed.groupBy(label, "cell").agg(F.count("*").alias("_n"))
    part = F.pmod(F.xxhash64("_key", "cell.t"), F.ceil(F.col("_n") * 2 / GROUP)).alias("part")
    grouped = filed.join(sizes, [label, "cell"]).groupBy(label, "cell", part).agg(
        F.collect_list(F.struct(F.col("_key").alias("key"), F.col("_z").alias("z"), F.col("_x").alias("x"))).alias("g")
    )
    apart = "aggregate(zip_with(a.z, b.z, (p, q) -> (p - q) * (p - q)), 0D, (s, d) -> s + d)"
    near = F.expr(f"""transform(g, a -> struct(a.key AS key, slice(array_sort(transform(filter(g, b -> b.key <> a.key),
        b -> struct({apart} AS distance, b.key AS key, b.x AS x))), 1, {k}) AS near))""")
    found = grouped.select(label, F.explode(near).alias("r")).select(label, "r.key", "r.near")
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k)
    return found.groupBy(label, "key").agg(best.alias("near"))


def smote(
    df: DataFrame, label: str, key: str, cols: Sequence[str], classes: Sequence[str], k: int = NEIGHBOURS, seed: int = 13
) -> DataFrame:
    """Synthetic rows that bring every class to the size of the largest: label, seed_key, other_key, copy, part, and ``cols`` as doubles.

    A synthetic row lies ``part`` of the way from its seed to one of the seed's neighbours, both real rows of the class. Which
    one, and how far, hangs on a hash of the seed's key and the number of the copy, so reruns agree. A seed that met no other row
    of its class is repeated. Rows that share a key count as one another's self, not as neighbours. Add them
    to the real rows with ``oversampled``. No classes or no rows give no rows.
    """
    usable = materialize(allotted(df, label, key, cols, classes, seed), "smote-seeds")
    near = neighbours(usable, label, key, cols, k, seed)
    seeds = usable.where("copies > 0").select(label, F.col(key).alias("_key"), "copies", F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    met = seeds.join(near.withColumnRenamed("key", "_key"), [label, "_key"], "left")
    copies = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    among = F.coalesce(F.size("near"), F.lit(0))
    at = F.floor(hash_unit("_key", "copy", seed=seed + 1) * among).cast("int") + 1
    # A plain index would be evaluated for empty lists, too.
    chosen = copies.withColumn("_to", F.when(among > 0, F.try_element_at("near", at)))
    part = F.when(F.col("_to").isNotNull(), hash_unit("_key", "copy", seed=seed + 2)).otherwise(0.0)
    made = chosen.withColumn("part", part)
    moved = [
        (F.col("_x")[i] + F.col("part") * (F.coalesce(F.col("_to")["x"][i], F.col("_x")[i]) - F.col("_x")[i])).alias(c) for i, c in enumerate(cols)
    ]
    other = F.coalesce(F.col("_to")["key"], F.col("_key")).alias("other_key")
    return made.select(label, F.col("_key").alias("seed_key"), other, "copy", "part", *moved)


def oversampled(df: DataFrame, label: str, key: str, cols: Sequence[str], classes: Sequence[str], k: int = NEIGHBOURS, seed: int = 13) -> DataFrame:
    """The real rows of ``classes`` and the synthetic ones (without key), with label, key, ``cols`` and whether they are synthetic."""
    real = df.where(F.col(label).isin(*classes)).select(label, key, *[F.col(c).cast("double").alias(c) for c in cols], F.lit(False).alias("synthetic"))
    made = smote(df, label, key, cols, classes, k, seed)
    no_key = F.lit(None).cast(df.schema[key].dataType).alias(key)
    return real.unionByName(made.select(label, no_key, *cols, F.lit(True).alias("synthetic")))
