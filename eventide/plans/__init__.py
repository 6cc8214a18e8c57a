"""Registered queries (Spark) and their SQL oracle (DuckDB)."""

from .oracle import oracle_sql
from .registry import QUERIES

__all__ = ["QUERIES", "oracle_sql"]
