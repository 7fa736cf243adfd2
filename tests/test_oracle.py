"""Every registered query with checking SQL gives what an independent engine gives."""

from __future__ import annotations

import os

import duckdb
import pytest

from compare import duck, duck_bag, spark_bag
from shoplens.registry import oracle_sql, queries

ORACLES = oracle_sql()
SIZES = os.environ.get("ORACLE_SIZES", "sf0.01").split()

# DuckDB type names for the Spark types in use.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


# The given tables with one key that holds a third of the rows, with NULLs and repeated customers.
HARD = {
    "orders": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 40 <> 1 THEN o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 30 <> 1 THEN o_orderdate END AS o_orderdate,
        CASE WHEN o_orderkey % 20 <> 1 THEN o_orderpriority END AS o_orderpriority FROM t""",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_suppkey % 3 = 0 THEN 9 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_suppkey % 3 = 1 THEN 4 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_linenumber % 5 <> 1 THEN l_discount END AS l_discount) FROM t""",
    "events": """SELECT event_id,
        CASE WHEN event_id % 20 = 1 THEN NULL WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-09 10:02:03.5' ELSE ts END AS ts,
        CASE WHEN event_id % 30 = 1 THEN NULL WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 0 THEN 'click' ELSE event_type END AS event_type, value,
        CASE WHEN event_id % 40 = 1 THEN NULL ELSE props END AS props FROM t""",
    "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 9 <> 1 THEN c_mktsegment END AS c_mktsegment) FROM t
        UNION ALL SELECT * FROM t WHERE c_custkey IN (7, 8)""",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 9 <> 1 THEN p_type END AS p_type) FROM t",
    **{t: "SELECT * FROM t" for t in ("nation", "region", "supplier")},
}


@pytest.fixture(scope="session")
def folders(testdata, tmp_path_factory):
    hard = tmp_path_factory.mktemp("hard")
    with duckdb.connect() as con:
        for table, sql in HARD.items():
            con.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{testdata}/sf0.001/{table}.parquet')")
            con.execute(f"COPY ({sql}) TO '{hard}/{table}.parquet' (FORMAT parquet)")
    return {"hard": str(hard), **{size: f"{testdata}/{size}" for size in SIZES}}


@pytest.mark.parametrize("size", [*SIZES, "hard"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, folders, name, size):
    folder = folders[size]
    df = queries()[name](spark, folder)
    with duck(folder) as con:
        columns, expected = duck_bag(con, ORACLES[name])
        found_columns, found = spark_bag(df)
        assert found_columns == columns
        assert found.total() == expected.total() > 0
        assert found == expected, (list((found - expected))[:3], list((expected - found))[:3])
        types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
        assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())
