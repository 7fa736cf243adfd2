from __future__ import annotations

import os

import duckdb
import pytest

TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def oracle(testdata):
    """A function (sql, size) -> (columns, rows) on the given tables."""

    def run(sql, size="sf0.01"):
        with duckdb.connect() as con:
            for table in TABLES:
                path = f"{testdata}/{size}/{table}.parquet"
                if os.path.exists(path):
                    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
            result = con.execute(sql)
            return [c[0] for c in result.description], result.fetchall()

    return run


@pytest.fixture(scope="session")
def make(spark):
    """A function rows of (doc_id, text, lang, source) -> documents with further columns whose names clash."""

    def build(rows, clash=True):
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS)
        if not clash:
            return df
        wide = df.selectExpr("*", "'x' AS a", "1 AS b", "2 AS c", "3 AS d", "4 AS e")
        return wide.toDF(*df.columns, "TEXT", "key", "size", "score", "doc_id")

    return build


@pytest.fixture(scope="session")
def odd():
    """Documents with nulls in every column, empty and long texts, ties and repeated rows."""
    return [
        (1, None, None, None), (2, "", "en", "a"), (None, "no key here at all", "en", "a"), (3, "  \n\t ", "de", "b"),
        (4, "word " * 60_000, "en", "a"), (5, "same text again here", "en", "a"), (6, "same text again here", None, "b"),
        (6, "same text again here", None, "b"), (7, "x" * 200_000, "xx", None), (None, None, None, None),
    ]
