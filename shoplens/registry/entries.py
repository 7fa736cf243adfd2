"""Collects the registered queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder) -> DataFrame, and SQL with the same result."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in _queries:
            raise ValueError(f"query {key!r} is registered twice")
        _queries[key] = function
        if oracle is not None:
            _oracles[key] = oracle
        return function

    return register


def _load() -> None:
    from shoplens.registry import (  # noqa: F401  (imported for what they register)
        distributions,
        extensions,
        models,
        reports,
        storage,
        streams,
    )


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)
