"""Table profiles: sizes, NULLs, numeric summaries, schemas, keys. One pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shoplens.functions.columns import near


def quoted(name: str) -> Column:
    """Column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of each table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULL count of every column of every table, from a single aggregate per table."""
    profiles = []
    for name, df in tables.items():
        per_column = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    (F.count("*") - F.count(quoted(c))).alias("null_count"),
                )
                for c in df.columns
            ]
        )
        profiles.append(
            df.agg(per_column.alias("columns")).select(
                F.lit(name).alias("table_name"), F.inline("columns")
            )
        )
    return reduce(DataFrame.unionByName, profiles)


def numeric_summary(
    df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None
) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per numeric column."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]

    def shown(value: Column) -> Column:
        value = value.cast("double")
        return value if digits is None else near(value, digits)

    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(quoted(c)).alias("non_null"),
                shown(F.avg(quoted(c))).alias("mean"),
                shown(F.stddev(quoted(c))).alias("stddev"),
                shown(F.min(quoted(c))).alias("min"),
                shown(F.max(quoted(c))).alias("max"),
            )
            for c in cols
        ]
    )
    return df.agg(per_column.alias("columns")).select(F.inline("columns"))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column, and how many values it holds."""
    per_column = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(field.nullable).alias("nullable"),
                F.count(quoted(field.name)).alias("value_count"),
            )
            for i, field in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(per_column.alias("columns")).select(F.inline("columns"))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a fixed order."""
    return df.orderBy(*order_by).limit(n)


def key_quality(df: DataFrame, key: str, refs: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Checks on declared keys: one row per check with the number of rows that break it.

    ``refs`` maps a foreign-key column to (table, key column) it should point into. Keys are
    counted before they are compared, so a key that many rows share costs one row.
    """

    def check(name: str, bad_rows: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), F.coalesce(bad_rows, F.lit(0)).alias("bad_rows"))

    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    missing = F.sum(F.when(F.col("k").isNull(), F.col("n")))
    repeated = F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1))
    both = F.array(check(f"{key} is not null", missing), check(f"{key} is unique", repeated))
    checks = [per_key.agg(both.alias("checks")).select(F.inline("checks"))]
    for column, (table, target) in (refs or {}).items():
        used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
        orphans = used.join(table.select(F.col(target).alias("k")), "k", "left_anti")
        unmatched = check(f"{column} has a match", F.sum("n")).alias("c")
        checks.append(orphans.agg(unmatched).select("c.*"))
    return reduce(DataFrame.unionByName, checks)
