"""Registered queries and the DuckDB SQL they are checked against."""

from . import extra_queries, join_queries, report_queries, row_queries  # noqa: F401  (register on import)
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
