"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the bitmap that filters rows before they are shuffled: at most 2^18 rows of it, whatever the number of sets.
FILTER_BITS = 1 << 24


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """``df`` cut to the named columns: ``pick(df, key="doc_id", text="text")``.

    Columns are found by their exact name and by position, so further columns whose names
    repeat or differ only in case do no harm; of several with one name the first is taken.
    """
    numbered = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    missing = [name for name in wanted.values() if name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing, found {df.columns}")
    return numbered.select(*(F.col(f"_{df.columns.index(name)}").alias(to) for to, name in wanted.items()))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of a task's batches, without a copy: only one slice's texts need be Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def flagged(rows: DataFrame, needed: DataFrame, by: str, flag: str = "hit") -> DataFrame:
    """``rows`` with a column that is false where column ``by`` is not in ``needed`` for certain: a bitmap of ``FILTER_BITS`` hash values, broadcast."""
    place = F.xxhash64(by).bitwiseAND(F.lit(FILTER_BITS - 1))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(63).cast("int")
    words = needed.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    known = rows.withColumn("word", word).join(F.broadcast(words), "word", "left")
    return known.withColumn(flag, F.coalesce(F.getbit("bits", bit) == 1, F.lit(False))).drop("word", "bits")


def hex_digest(parts: Iterable[Column] | Column, sep: str = ",") -> Column:
    """SHA-256 of an array of strings joined by ``sep``, as lowercase hex digits."""
    return F.sha2(F.array_join(parts, sep), 256)
