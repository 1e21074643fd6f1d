"""Runnable queries over the test tables, each with the SQL that must give the same rows."""

from orderflow.catalog import column_queries, file_queries, generator_queries, relational_queries  # noqa: F401
from orderflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
