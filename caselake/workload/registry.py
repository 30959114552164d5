"""Name, Spark callable and SQL of every bound query."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = ("shaping", "layers", "cases", "increments", "events", "files")


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) and, where SQL can say it, its SQL."""
    def keep(function):
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function
    return keep


def _load() -> None:
    for module in _MODULES:
        import_module(f"caselake.workload.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
