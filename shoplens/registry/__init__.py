"""Every operator bound to the given tables, with the SQL that checks it."""

from shoplens.registry.entries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
