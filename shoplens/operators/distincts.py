"""Exact distinct counts that add up: bitmaps of integer keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.scratch import materialize


def bitmaps(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``by``, bucket, bits: which integer keys each group holds, a bitmap of 4 KB for every 32,768 successive keys.

    Equal keys meet as one bit before anything is shuffled, so a hot key or group is no more than its bitmaps. Stored, the
    bitmaps of days or months give those of any longer time without another look at the rows. NULL keys are not counted.
    """
    known = df.where(F.col(key).isNotNull())
    bucket, bit = F.bitmap_bucket_number(key), F.bitmap_bit_position(key)
    return known.groupBy(*by, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def merge_bitmaps(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return stored.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(stored: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """Distinct keys of each group. The rows of ``stored`` must be one per group and bucket."""
    return stored.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(out))


def distinct_per_period(df: DataFrame, key: str, ts: str, units: Sequence[str] = ("month", "quarter", "year"), out: str = "distinct") -> DataFrame:
    """unit, period_start, ``out``: exact distinct keys per calendar period, each unit merged from the one before.

    The bitmaps of the finest unit are stored, so the rows are read once. Units go from the finest to the coarsest and must nest. Rows without time or key are left out.
    """
    timed = df.where(F.col(ts).isNotNull()).select(F.trunc(F.to_date(ts), units[0]).alias("period_start"), key)
    stored, found = materialize(bitmaps(timed, key, ["period_start"]), "bitmaps"), None
    for i, unit in enumerate(units):
        if i:
            coarser = stored.withColumn("period_start", F.trunc("period_start", unit))
            stored = merge_bitmaps(coarser, ["period_start"])
        counts = count_bitmaps(stored, ["period_start"], out).select(F.lit(unit).alias("unit"), "period_start", out)
        found = counts if found is None else found.unionByName(counts)
    return found
