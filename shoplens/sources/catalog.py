"""Which files feed which table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from shoplens.sources import schemas
from shoplens.sources.readers import read_csv

# Table -> (word its file name holds, schema).
RAW_TABLES = {
    "customers": ("customer", schemas.CUSTOMERS),
    "products": ("product", schemas.PRODUCTS),
    "transactions": ("transaction", schemas.TRANSACTIONS),
    "clickstream": ("click", schemas.CLICKSTREAM),
}


def raw_glob(base: str, word: str) -> str:
    """Glob for CSV files (or folders of them) whose name holds ``word`` in any case."""
    any_case = "".join(f"[{c.lower()}{c.upper()}]" for c in word)
    return f"{base.rstrip('/')}/*{any_case}*.csv"


def load_raw(spark: SparkSession, name: str, bases: str | Sequence[str]) -> DataFrame:
    """The raw CSV of table ``name`` from the first folder in ``bases`` that has one."""
    word, schema = RAW_TABLES[name]
    folders = [bases] if isinstance(bases, str) else list(bases)
    for base in folders:
        try:
            return read_csv(spark, raw_glob(base, word), schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no CSV for table {name!r} in {folders}")


def load_table(spark: SparkSession, name: str, base: str) -> DataFrame:
    """The stored Parquet table ``name`` under ``base``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables visible to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
