"""Registry of the queries of the core operators, each with the SQL it is checked against."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP = "d1_unique_pairs"

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator that files a query, and its SQL where SQL can express it."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


_MODULES = ("text_queries", "gate_queries", "table_queries", "stage_queries", "record_queries")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"paralode.plans.{name}")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The SQL of the queries that have one."""
    _load()
    return dict(_SQL)
