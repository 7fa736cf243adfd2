"""Exact top-k search by inner product, by a three-phase uniform threshold.

The components of all vectors are cut into ``lists`` blocks. A block's local score of a vector is its part of
the inner product, and each block is a list, kept apart from the others. For a block of queries:

1. every list gives its k best local scores, per task; these few vectors are scored exactly, and their k-th best
   score is a safe cutoff t for each query;
2. the cutoffs are broadcast, and every list gives all entries of at least t / lists. A vector that is below that in
   every list is below t in total, so no result is missing. Sums of what was given, and t / lists for what was
   not, bound each total from above, and what cannot reach t is dropped;
3. the parts that were not given are looked up for the vectors that are left, which makes their scores exact.

Scores are integers, so nothing depends on the order of sums. Queries go in blocks of bounded size, each
against all vectors; copies of one vector beyond the k + 1 smallest ids can be in no result and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.tables import pick
from shoplens.scratch import materialize, scratch_path

LISTS = 2
#: Queries that are broadcast at a time.
QUERY_BLOCK = 4_096
#: Scores that a task holds at a time.
SCORES = 4_000_000


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """id, vec: components x as floor(scale * x). Rows without id or vector, or with a component that is null or not finite, are left out."""
    rows = pick(vectors, id=key, raw=vector).where("id IS NOT NULL AND raw IS NOT NULL")
    doubles = F.transform("raw", lambda x: x.cast("double"))
    odd = F.exists("raw", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return rows.where(~F.coalesce(odd, F.lit(True))).select("id", F.transform(doubles, lambda x: F.floor(x * scale)).alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in exact integers."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("an inner product may not fit a long")
    return left @ right.T


class _Block:
    """Queries: ids and vectors, cut into lists."""

    def __init__(self, ids: list[int], vectors: list[list[int]], lists: int, width: int) -> None:
        full = np.zeros((len(ids), lists * width), dtype=np.int64)
        for row, v in zip(full, vectors):
            row[: len(v)] = v
        self.ids = np.array(ids, dtype=np.int64)
        self.parts = [full[:, p * width : (p + 1) * width].copy() for p in range(lists)]
        self.order = np.argsort(self.ids, kind="stable")

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """list, rows, ids, local scores (vectors x queries) and which are not the query's own row."""
        lists = batch.column("list").to_numpy()
        rows, ids, slices = (batch.column("row").to_numpy(), batch.column("id").to_numpy(), _matrix(batch.column("slice")))
        for part in np.unique(lists):
            mine = np.flatnonzero(lists == part)
            step = max(1, SCORES // max(1, len(self.ids)))
            for a in range(0, len(mine), step):
                at = mine[a : a + step]
                local = _products(slices[at], self.parts[part])
                other = np.ones(local.shape, dtype=bool)
                sorted_ids = self.ids[self.order]
                left, right = np.searchsorted(sorted_ids, ids[at]), np.searchsorted(sorted_ids, ids[at], side="right")
                for i in np.flatnonzero(right > left):
                    other[i, self.order[left[i] : right[i]]] = False
                yield int(part), rows[at], ids[at], local, other


_ENTRY = "query int, list int, row long, id long, score long"


def _entries(query, part, rows, ids, scores) -> pa.RecordBatch:
    arrays = [pa.array(query, pa.int32()), pa.array(np.full(len(query), part), pa.int32()), *(pa.array(x, pa.int64()) for x in (rows, ids, scores))]
    return pa.RecordBatch.from_arrays(arrays, ["query", "list", "row", "id", "score"])


def _best(batches, block: _Block, k: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: the k best entries of each list and query among the task's vectors."""
    kept: dict[int, tuple] = {}
    least = np.iinfo(np.int64).min
    for batch in batches:
        for part, rows, ids, local, other in block.scores(batch):
            local = np.where(other, local, least)
            if len(rows) > k:
                top = np.argpartition(local, len(rows) - k, axis=0)[-k:]
            else:
                top = np.repeat(np.arange(len(rows))[:, None], local.shape[1], axis=1)
            new = (rows[top], ids[top], np.take_along_axis(local, top, axis=0))
            if part in kept:
                new = tuple(np.concatenate(x) for x in zip(kept[part], new))
                top = np.argsort(new[2], axis=0)[-k:]
                new = tuple(np.take_along_axis(x, top, axis=0) for x in new)
            kept[part] = new
    for part, (rows, ids, scores) in kept.items():
        at, query = np.nonzero(scores > least)
        yield _entries(query, part, rows[at, query], ids[at, query], scores[at, query])


def _above(batches, block: _Block, cutoffs: np.ndarray, lists: int) -> Iterator[pa.RecordBatch]:
    """Phase 2: all entries of at least an equal share of the cutoff. Shares are rounded up, as scores are integers."""
    share = -(-cutoffs // lists)
    for batch in batches:
        for part, rows, ids, local, other in block.scores(batch):
            at, query = np.nonzero(other & (local >= share[None, :]))
            yield _entries(query, part, rows[at], ids[at], local[at, query])


def _looked_up(pairs: DataFrame, lists_: DataFrame, block) -> DataFrame:
    """query, row, id -> with the exact score: the parts of a vector are met by its row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        for batch in batches:
            part, query = batch.column("list").to_numpy(), batch.column("query").to_numpy()
            slices = _matrix(batch.column("slice")) if batch.num_rows else np.zeros((0, 1), dtype=np.int64)
            scores = np.zeros(batch.num_rows, dtype=np.int64)
            for p in np.unique(part):
                mine = part == p
                scores[mine] = np.einsum("ij,ij->i", slices[mine], b.parts[p][query[mine]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("row"), batch.column("id"), pa.array(scores)], ["query", "row", "id", "score"]
            )

    met = pairs.select("query", "row", "id").join(lists_.select("row", "list", "slice"), "row")
    parts = met.mapInArrow(scored, "query int, row long, id long, score long")
    return parts.groupBy("query", "row", "id").agg(F.sum("score").alias("score"))


def _kth(scored: DataFrame, k: int, count: int) -> np.ndarray:
    """The k-th best score of each query, one number for each; where there are fewer, less than any score."""
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    kth = scored.withColumn("place", F.row_number().over(best)).where(F.col("place") == k).select("query", "score").toPandas()
    out = np.full(count, -(2**62), dtype=np.int64)
    out[kth["query"].to_numpy(dtype=np.int64)] = kth["score"].to_numpy(dtype=np.int64)
    return out


def _searched(lists_: DataFrame, block: _Block, k: int, lists: int) -> DataFrame:
    """The k best vectors for each query of a block: query_id, rank, vec_id, score."""
    spark = lists_.sparkSession
    sent = spark.sparkContext.broadcast(block)
    best = lists_.mapInArrow(lambda it: _best(it, sent.value, k), _ENTRY)
    place = Window.partitionBy("query", "list").orderBy(F.desc("score"), "id", "row")
    few = best.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k).select("query", "row", "id").distinct()
    cutoffs = _kth(_looked_up(few, lists_, sent), k, len(block.ids))
    cut = spark.sparkContext.broadcast(cutoffs)
    given = lists_.mapInArrow(lambda it: _above(it, sent.value, cut.value, lists), _ENTRY)
    limits = spark.createDataFrame(
        pd.DataFrame({"query": np.arange(len(cutoffs), dtype=np.int32), "query_id": block.ids, "cutoff": cutoffs}),
        "query int, query_id long, cutoff long",
    )
    sums = given.groupBy("query", "row", "id").agg(F.sum("score").alias("seen"), F.count("*").alias("n"))
    # A part that was not given is at most one less than the share, rounded up.
    share = F.expr(f"(cutoff + {lists - 1} - pmod(cutoff + {lists - 1}, {lists}L)) div {lists}")  # rounded up
    bounded = materialize(
        sums.join(F.broadcast(limits), "query").where(F.col("seen") + (lists - F.col("n")) * (share - 1) >= F.col("cutoff")),
        "bounded",
    )
    whole = bounded.where(F.col("n") == lists).select("query", "row", "id", F.col("seen").alias("score"))
    exact = whole.unionByName(_looked_up(bounded.where(F.col("n") < lists), lists_, sent))
    ranked = exact.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")))
    return ranked.where(F.col("rank") <= k).join(F.broadcast(limits), "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256, lists: int = LISTS
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every query, ties to the smaller vec_id.

    is_query is a condition on ``id``. Rows with the query's id are no candidates; other rows that repeat are candidates
    one by one, and a query that repeats is asked once. A query id with several vectors is as many queries.
    A shorter vector counts as ending in zeros. With fewer candidates than k all are returned; an empty table,
    or one without queries, gives no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, key, vector, scale), "quantised")
    size = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    width = max(1, -(-size // lists))
    # Of equal vectors the k + 1 smallest ids: one of them may be the query's own.
    copies = Window.partitionBy("vec").orderBy("id")
    useful = rows.withColumn("place", F.dense_rank().over(copies)).where(F.col("place") <= k + 1)
    full = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(lists * width) - F.size("vec")))
    numbered = useful.select(F.monotonically_increasing_id().alias("row"), "id", full.alias("vec"))
    parts = F.array(*(F.struct(F.lit(p).alias("list"), F.slice("vec", p * width + 1, width).alias("slice")) for p in range(lists)))
    lists_ = materialize(numbered.select("row", "id", F.explode(parts).alias("p")).select("row", "id", "p.list", "p.slice"), "lists")
    queries = materialize(rows.where(is_query).distinct(), "queries")
    out = scratch_path(spark, "found")
    ids: list[int] = []
    found: list[list[int]] = []
    n = 0

    def ask() -> None:
        nonlocal n, ids, found
        _searched(lists_, _Block(ids, found, lists, width), k, lists).write.parquet(f"{out}/part={n}")
        n, ids, found = n + 1, [], []

    for row in queries.toLocalIterator():  # a partition at a time
        ids.append(row.id)
        found.append(row.vec)
        if len(ids) == QUERY_BLOCK:
            ask()
    if ids or not n:
        ask()
    schema = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(f"{schema}, part int").parquet(out).drop("part")
