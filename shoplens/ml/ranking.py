"""How well scores rank: the exact area under the ROC curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.scratch import materialize


def exact_auc(scored: DataFrame, by: str = "model", score: str = "score", label: str = "label") -> DataFrame:
    """``by``, positives, negatives, auc: the share of (positive, negative) pairs in which the positive scores higher, ties halved.

    All models in one job. Rows meet as counts per distinct score first; these are laid out in ranges of scores, and running
    counts go in two levels, over a model's ranges and within each, so that no task has to hold a model's scores.
    A positive is a label of 1. Rows without score or label are left out; where a class is missing the area is NULL.
    """
    known = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull() & F.col(by).isNotNull())
    positive = F.col(label) == 1
    cells = known.groupBy(by, score).agg(F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives"))
    # Stored with its range, so that both reads below see the same ranges.
    placed = materialize(cells.repartitionByRange(by, score).withColumn("slice", F.spark_partition_id()), "score-cells")
    before = Window.partitionBy(by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy(by, "slice").agg(F.sum("negatives").alias("n"))
    starts = slices.select(by, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(by, "slice").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("start") + F.coalesce(F.sum("negatives").over(within), F.lit(0))
    ranked = placed.join(starts, [by, "slice"]).withColumn("won", F.col("positives") * (lower.cast("double") + F.col("negatives") / 2))
    sums = ranked.groupBy(by).agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.sum("won").alias("won"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(by, "positives", "negatives", (F.col("won") / F.nullif(pairs, F.lit(0.0))).alias("auc"))
