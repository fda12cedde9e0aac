"""Registered queries over the given tables, each with its SQL twin."""

from workload import diffs, documents, inputs, reconciliation, register, reports  # noqa: F401
from workload.base import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
