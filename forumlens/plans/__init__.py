"""Registered queries: each is ``fn(spark, sf_dir) -> DataFrame`` over the
driver's parquet tables, with an optional DuckDB oracle SQL string."""

from forumlens.plans.registry import all_queries, all_oracle_sql

__all__ = ["all_queries", "all_oracle_sql"]
