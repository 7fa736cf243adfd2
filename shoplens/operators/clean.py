"""Cleaning steps. Each skips columns that the table lacks and adds one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def clean_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim blanks."""
    return df.withColumns({c: F.trim(c) for c in present(df, cols)})


def parse_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to date; text that is no date becomes NULL, whatever the ANSI setting."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in present(df, cols)})


def parse_timestamps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to timestamp; text that is no timestamp becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in present(df, cols)})


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Put a fixed value in place of NULL."""
    return df.withColumns({c: F.coalesce(c, F.lit(values[c])) for c in present(df, list(values))})


def parse_json(df: DataFrame, col: str, ddl: str, out: str) -> DataFrame:
    """JSON text to a struct; unreadable text gives a struct of NULLs, NULL stays NULL."""
    return df.withColumns({out: F.from_json(c, ddl) for c in present(df, [col])})


def json_failures(df: DataFrame, raw: str, parsed_field: str) -> DataFrame:
    """How many non-NULL JSON texts did not yield ``parsed_field``."""
    failed = F.col(raw).isNotNull() & F.col(parsed_field).isNull()
    return df.agg(
        F.count(raw).alias("parsed_rows"),
        F.coalesce(F.count_if(failed), F.lit(0)).alias("failed_rows"),
    )
