"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.scratch import materialize


def stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b), longs, either way round -> (node, root): each linked node but the smallest of its component.

    Alternates large and small stars (Kiveris et al., "Connected components in MapReduce and beyond"): nodes
    hand their larger neighbours, then their smaller ones, to the smallest neighbour, until every component is
    one star. A hub meets its neighbours only in sums and in joins that Spark may split; no node's neighbours
    are gathered. Every round is stored, so a lost executor costs one round. No edges give no rows.
    """
    now = materialize(_apart(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(_apart(large), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(_apart(handed.unionByName(low.select("u", F.col("m").alias("v")))), "small-star")
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _apart(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does, but for a chance of some 2^-60."""
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.bitwiseAND(2**31 - 1))).first())
