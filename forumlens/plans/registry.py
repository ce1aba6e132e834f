"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is its DuckDB
    oracle (omitted for results that are not SQL-expressible)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def _load() -> None:
    # importing the modules registers their queries
    from forumlens.plans import chain, evaluation, graph, mining, models, qa, text  # noqa: F401


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
