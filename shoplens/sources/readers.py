"""Batch and streaming scans."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Doubling the quote inside a quoted field is what keeps JSON cells in one piece.
QUOTED = {"quote": '"', "escape": '"'}

# How this library stores text formats, so that nothing is lost: times with all six digits, NULL apart from "".
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
STORED_CSV = {**TIMES, "nullValue": r"\N"}


def as_struct(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | StructType | None = None,
    quoted: bool = True,
    stored: bool = False,
    strict: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header row, read under ``schema`` if the header has its columns, else inferred.

    Spark binds CSV columns to a schema by position, so the header is looked at first (one line of one
    file) and columns are bound by name, as Spark compares names; further columns are left out. Where names
    are missing the types are inferred, with a warning, or an error if ``strict``. Later files whose header
    differs from the first fail the query instead of filling the wrong columns.

    ``stored`` reads what ``write_table`` wrote. Other files with line breaks inside cells need ``multiLine=True``,
    which gives up splitting files; without it Spark would take each line for a row.
    """
    settings = {"header": True, **(QUOTED if quoted else {}), **(STORED_CSV if stored else {}), **options}
    reader = spark.read.options(**settings)
    if schema is None:
        found = spark.read.options(**settings, inferSchema=True).csv(path)
        return with_line_breaks(found) if stored else found
    wanted = as_struct(schema)
    header = reader.csv(path).columns
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    known = {name if exact else name.lower(): name for name in wanted.names}
    matched = {known[n]: i for i, name in reversed(list(enumerate(header))) if (n := name if exact else name.lower()) in known}
    if len(matched) == len(wanted.names):
        types = {i: wanted[name].dataType for name, i in matched.items()}
        in_file_order = StructType([StructField(name, types.get(i, StringType())) for i, name in enumerate(header)])
        found = spark.read.options(**settings, enforceSchema=False).schema(in_file_order).csv(path)
        found = found.select(*[quoted_name(header[matched[name]]).alias(name) for name in wanted.names])
    else:
        missing = sorted(set(wanted.names) - set(matched))
        if strict:
            raise ValueError(f"{path} lacks the columns {missing}")
        warnings.warn(f"{path} lacks the columns {missing}; its types are inferred", stacklevel=2)
        found = spark.read.options(**settings, inferSchema=True).csv(path)
    return with_line_breaks(found) if stored else found


def quoted_name(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without_line_breaks(df: DataFrame) -> DataFrame:
    r"""Text with line breaks and backslashes as \n, \r and \\, so that a row stays one line."""
    steps = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
    return _texts(df, lambda c: reduce(lambda text, s: F.replace(text, F.lit(s[0]), F.lit(s[1])), steps, c))


def with_line_breaks(df: DataFrame) -> DataFrame:
    """The inverse of ``without_line_breaks``; a doubled backslash is set aside while the others are read."""
    steps = (("\\\\", "\0"), ("\\n", "\n"), ("\\r", "\r"), ("\0", "\\"))
    return _texts(df, lambda c: reduce(lambda text, s: F.replace(text, F.lit(s[0]), F.lit(s[1])), steps, c))


def _texts(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(quoted_name(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else quoted_name(f.name)
            for f in df.schema.fields
        ]
    )


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: str | StructType) -> DataFrame:
    """JSON-lines files under a given schema; no inference pass. Times may have six digits."""
    return spark.read.schema(schema).json(paths)


def stream_json(
    spark: SparkSession, path: str, schema: str | StructType, max_files: int | None = 5
) -> DataFrame:
    """Unbounded table over a folder that receives JSON-lines files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: str | StructType, max_files: int | None = None
) -> DataFrame:
    """Unbounded table over Parquet, be ``path`` a folder or one file; ``max_files`` bounds a micro-batch.

    The stream source takes folders or globs only, so the last letter goes into brackets,
    which makes the path a glob that matches itself.
    """
    glob = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(glob)
