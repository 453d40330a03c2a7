"""Documents read in a wrong encoding (p9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.encodings import wrongly_decoded
from tessera.session import table


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return wrongly_decoded(table(spark, folder, "documents"), "doc_id", "text").select("doc_id")


def p9_restored(spark: SparkSession, folder: str) -> DataFrame:
    found = wrongly_decoded(table(spark, folder, "documents"), "doc_id", "text")
    return found.withColumn("encodings", F.array_join("encodings", ", "))


QUERIES = {"p9_found": p9_found, "p9_restored": p9_restored}
SQL: dict[str, str] = {}
