"""Held-out items in documents (p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.leakage import leaked_items
from tessera.session import table


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "heldout_items"), "item_id", "text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).where("exact_words").select("doc_id", "item_id").distinct()


def p7_leaked_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Every leak, small edits included, with the share of the item that was kept."""
    return _leaks(spark, folder).select("doc_id", "item_id", F.round(F.col("score") / F.col("item_chars"), 4).alias("kept_share"), "exact_words")


QUERIES = {"p7_found": p7_found, "p7_leaked_shares": p7_leaked_shares}

_GRAMS = r"""SELECT {id}, unnest(list_transform(range(1, len(w) - 10), lambda i: list_aggregate(w[i:i + 11], 'string_agg', ' '))) AS gram
FROM (SELECT {id}, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM {table}) WHERE len(w) >= 12"""

SQL = {
    "p7_found": f"WITH d AS ({_GRAMS.format(id='doc_id', table='documents')}), h AS ({_GRAMS.format(id='item_id', table='heldout_items')}) SELECT DISTINCT doc_id, item_id FROM d JOIN h USING (gram)",
}
