"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order. The virtual finish time of a
document is the number of words that its source has sent once the document is through, over
the source's target; a source may be sent up to ``epochs`` times over. All queues are then
merged by virtual finish time and cut where the words sent would exceed the total budget.

Running sums are taken in two levels, so no source, however large, meets in one task: the
shuffled order is cut into buckets of some ``BUCKET_ROWS`` rows, buckets are summed, and a row
adds its place inside its bucket to the sum of the buckets before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.tables import WORD, pick
from shoplens.scratch import materialize

#: Rows in a bucket of the two-level running sums, about.
BUCKET_ROWS = 2_000
#: Bits of the shuffle key.
KEY_BITS = 60


@dataclass
class Mix:
    """sources: source, rows, source_size, weight, target; cut: the last virtual finish time that is sent."""

    sources: DataFrame
    cut: float
    budget: int
    seed: int
    epochs: int


def words(text: Column) -> Column:
    """Words of a text; of null none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(key: Column, seed: int) -> Column:
    """A number of ``KEY_BITS`` bits that looks random; the same in every run and in other engines."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """key, source, size and place in the shuffle of every document; nothing else."""
    rows = pick(docs, key=key, text=text, source=source)
    return rows.select("key", "source", words(F.col("text")).alias("size"), shuffle_key(F.col("key"), seed).alias("place"))


def _ranked(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Sources in the order of their code points, null last, with ``weights`` dealt in turn.

    Sources are summed rows, yet there may be many: they are sorted by ranges, and a row's rank
    is its place within its range after the ranges before it.
    """
    order = F.col("source").asc_nulls_last()
    ranges = materialize(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ranges.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    rank = F.col("ahead") + F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    dealt = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    return ranges.join(ahead, "range").select("source", "rows", "source_size", dealt.alias("weight"))


def targets(sources: DataFrame, epochs: int) -> tuple[DataFrame, int]:
    """Adds ``target``: the budget shared by weight, at most ``epochs`` times a source's size.

    What a full source cannot take is shared again among the others, by weight, until none is
    above its limit. Each round is one aggregate; a source that is full stays so.
    """
    limit = F.col("source_size") * epochs
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, None
    while True:
        is_full = limit < share * F.col("weight") if full is not None else F.lit(False)
        row = sources.agg(
            F.sum(F.when(is_full, limit)).alias("full"),
            F.sum(F.when(~is_full, F.col("weight"))).alias("weight"),
            F.count(F.when(is_full, 1)).alias("n"),
        ).first()
        if row.n == full or not row.weight:
            break
        full, share = row.n, (budget - (row.full or 0)) / row.weight
    target = F.when(limit < F.lit(share) * F.col("weight"), limit.cast("double")).otherwise(F.lit(share) * F.col("weight"))
    return sources.withColumn("target", target), budget


def _bucket(rows: Column) -> Column:
    """Leading bits of the shuffle key that cut a source of so many rows into buckets of BUCKET_ROWS or less."""
    return F.greatest(F.lit(0), F.ceil(F.log2(rows / F.lit(BUCKET_ROWS)))).cast("int")


def queued(rows: DataFrame, mix_sources: DataFrame) -> DataFrame:
    """Adds source_size, target and ``sent``: the words its source has sent when a document is through once.

    rows: key, source, size, place, and whatever else shall be kept. Equal places are taken in the order
    of key and size; rows that still tie are alike.
    """
    known = mix_sources.withColumn("bits", _bucket(F.col("rows"))).select(
        F.col("source").alias("of"), "source_size", "target", "bits"
    )
    dealt = rows.join(known, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "bucket", F.expr(f"shiftright(place, {KEY_BITS} - bits)")
    )
    earlier = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("of", "bucket").agg(F.sum("size").alias("words")).select(
        F.col("of").alias("of_"), F.col("bucket").alias("bucket_"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead"),
    )
    inside = Window.partitionBy("of", "bucket").orderBy("place", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("within", F.sum("size").over(inside))
    return placed.join(sums, F.col("of").eqNullSafe(F.col("of_")) & (F.col("bucket") == F.col("bucket_"))).withColumn(
        "sent", F.col("ahead") + F.col("within")
    ).drop("of", "of_", "bucket", "bucket_", "ahead", "within", "bits")


def finish(epoch: int) -> Column:
    """Virtual finish time of a document that is sent for the ``epoch``-th time, from 0."""
    return (F.col("source_size") * epoch + F.col("sent")) / F.when(F.col("target") > 0, F.col("target"))


def _cut(rows: DataFrame, budget: int, epochs: int) -> float:
    """The largest virtual finish time up to which no more than ``budget`` words are sent.

    Finish times spread evenly over 0 to 1, where the targets are met, so equal slices of time hold like
    numbers of documents. The sums of the slices show where the budget ends; only that slice is sorted.
    """
    n = rows.count()
    slices = max(1, epochs * n // BUCKET_ROWS)
    times = rows.select("size", F.explode(F.array(*(finish(e) for e in range(epochs)))).alias("time")).where("size > 0")
    sliced = times.withColumn("slice", F.floor(F.least(F.col("time"), F.lit(2.0)) * slices))
    so_far = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sums = sliced.groupBy("slice").agg(F.sum("size").alias("words"))
    # Slices are sums, one for some BUCKET_ROWS rows; only they are put in one order.
    over = sums.select("slice", "words", F.sum("words").over(so_far).alias("upto")).where(F.col("upto") > budget)
    first = over.orderBy("slice").first()
    if first is None:
        return float("inf")
    ahead = first.upto - first.words
    by_time = Window.orderBy("time")
    last = sliced.where(F.col("slice") == first.slice).select("time", (F.sum("size").over(by_time) + ahead).alias("upto"))
    found = last.where(F.col("upto") <= budget).agg(F.max("time")).first()[0]
    return found if found is not None else (first.slice / slices) * (1 - 2**-52)


def plan(
    rows: DataFrame, weights: list[float] | None = None, seed: int = 0, epochs: int = 3
) -> tuple[Mix, DataFrame]:
    """Targets and cut for ``rows`` of ``sized``, and those rows, stored, in their queues."""
    rows = materialize(rows, "sized")
    sums = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    aimed, budget = targets(materialize(_ranked(sums, weights or [1, 2, 3]), "weights"), epochs)
    aimed = materialize(aimed, "targets")
    placed = materialize(queued(rows, aimed), "queued")
    return Mix(aimed, _cut(placed, budget, epochs), budget, seed, epochs), placed


def times_sent(mix: Mix) -> Column:
    """How often a document of ``queued`` is sent."""
    hits = [F.when(finish(e) <= F.lit(mix.cut), 1).otherwise(0) for e in range(mix.epochs)]
    return sum(hits[1:], hits[0])


def mix_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: list[float] | None = None, seed: int = 0, epochs: int = 3,
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, times, taken, finish.

    weights are dealt in turn to the sources by code point, null last. A null text has no words; documents
    without words are never sent, nor is anything of a source without words (its target is 0). Repeated
    rows queue one by one. An empty table gives no rows.
    """
    mix, placed = plan(sized(docs, key, text, source, seed), weights, seed, epochs)
    times = F.when(F.col("size") > 0, times_sent(mix)).otherwise(0)
    return placed.select(
        "key", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
        times.alias("times"), (F.col("size") * times).alias("taken"), finish(0).alias("finish"),
    )


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: list[float] | None = None, seed: int = 0, epochs: int = 3,
) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document as often as it is sent.

    A source sends a prefix of its shuffled order, whole rounds first. The prefix of each source is kept as
    the words sent, so documents are placed in their queues again, with all their columns.
    """
    mix, _ = plan(sized(docs, key, text, source, seed), weights, seed, epochs)
    at = {name: docs.columns.index(name) for name in (key, text, source)}
    numbered = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    rows = numbered.select(
        F.col(f"_{at[key]}").alias("key"), F.col(f"_{at[source]}").alias("source"),
        words(F.col(f"_{at[text]}")).alias("size"), shuffle_key(F.col(f"_{at[key]}"), seed).alias("place"), "*",
    )
    times = F.when(F.col("size") > 0, times_sent(mix)).otherwise(0)
    sent = queued(rows, mix.sources).withColumn("times", times).where("times > 0")
    copies = sent.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return copies.select(*(F.col(f"_{i}") for i in range(len(docs.columns)))).toDF(*docs.columns)
