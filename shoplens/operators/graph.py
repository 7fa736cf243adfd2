"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.scratch import materialize


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (node), edges (a, b; either way round) -> node, label: the least node of its component.

    Every node takes the least label among its neighbours', then the label of its label, until none changes: labels jump twice
    as far each round. A hub's neighbours meet only in a minimum, which is taken before the shuffle. Each round is stored.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "graph-edges")
    labels = materialize(nodes.select("node", F.col("node").alias("label")).distinct(), "graph-labels")
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("heard"))
        least = labels.join(heard, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        least = materialize(least, "graph-heard")
        jump = least.select(F.col("node").alias("via"), F.col("label").alias("farther"))
        jumped = least.join(jump, F.col("label") == F.col("via")).select("node", "old", F.least("label", "farther").alias("label"))
        jumped = materialize(jumped, "graph-labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
