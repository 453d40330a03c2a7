"""Queries on training text and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import queries_p1, queries_p2, queries_p5, queries_p6, queries_p7, queries_p8, queries_p9

MODULES = (queries_p1, queries_p2, queries_p5, queries_p6, queries_p7, queries_p8, queries_p9)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for m in MODULES for name, text in m.SQL.items()}
