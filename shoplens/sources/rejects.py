"""Rows that do not fit their schema, set apart with their file and the reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.sources.readers import QUOTED, as_struct, quoted_name

BAD_LINE = "_bad_line"


@dataclass
class Checked:
    """``good`` has the schema's columns; ``rejected`` has file, reason, line (what was read, comma-joined).

    Each row of the files is in just one of the two.
    """

    good: DataFrame
    rejected: DataFrame


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], schema: str | StructType, **options) -> Checked:
    """CSV under a schema, in which nothing turns to NULL unseen. Columns are bound by position.

    All cells are read as text. A row is rejected if it has more or fewer cells than the schema ("cells"), if the text of a
    cell is not of the column's type, or if a column that the schema declares as not NULL is empty (the columns' names,
    comma-joined). An empty cell of another column is NULL and no reason.
    """
    wanted = as_struct(schema)
    texts = StructType([StructField(f.name, StringType()) for f in wanted.fields] + [StructField(BAD_LINE, StringType())])
    settings = {"header": True, **QUOTED, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    raw = spark.read.options(**settings).schema(texts).csv(path).withColumn("_file", F.input_file_name())
    typed, faults = [], []
    for f in wanted.fields:
        cell = quoted_name(f.name)
        value = cell if isinstance(f.dataType, StringType) else cell.try_cast(f.dataType)
        fault = value.isNull() if not f.nullable else value.isNull() & cell.isNotNull()
        typed.append(value.alias(f.name))
        faults.append(F.when(fault, F.lit(f.name)))
    reason = F.when(F.col(BAD_LINE).isNotNull(), "cells").otherwise(F.concat_ws(",", *faults))
    marked = raw.withColumn("_reason", reason)
    cells = F.concat_ws(",", *[F.coalesce(quoted_name(f.name), F.lit("")) for f in wanted.fields])
    rejected = marked.where("_reason <> ''").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.coalesce(F.col(BAD_LINE), cells).alias("line")
    )
    return Checked(marked.where("_reason = ''").select(*typed), rejected)
