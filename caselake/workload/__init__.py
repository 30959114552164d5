"""The operators bound to the given tables, each beside its SQL equivalent."""

from caselake.workload.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
