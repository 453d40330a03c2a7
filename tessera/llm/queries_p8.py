"""Mixtures of the documents' sources (p8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.mixing import measured, mixtures
from tessera.session import cut, table


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = cut(measured(table(spark, folder, "documents"), "doc_id", "text", "source", "lang"))
    return mixtures(docs, table(spark, folder, "mixture_targets"))


def p8_draws(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[0].withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[1]


def p8_marginals(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of languages and topics wanted, after raking, and drawn."""
    return _mixed(spark, folder)[2]


QUERIES = {"p8_draws": p8_draws, "p8_shares": p8_shares, "p8_marginals": p8_marginals}
SQL: dict[str, str] = {}
