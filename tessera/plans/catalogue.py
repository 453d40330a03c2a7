"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import file_queries, integrity, queries as pipeline

MODULES = (pipeline, integrity, file_queries)


def entry(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts fanned out over the profiles, cleaned and templated, counted by account."""
    return pipeline.tasks_by_account_profile(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
