"""Registered queries: each operator on the given tables, with SQL to check it where SQL can."""

from catalog import classification, interactions, jobs, learning, profiling, ranking, sampling, text, vectors  # noqa: F401
from catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
