"""Release files in shards (p2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.packing import packed_files
from tessera.session import table


def p2_shards(spark: SparkSession, folder: str) -> DataFrame:
    """A shard per file and capacity; files of unknown size have none."""
    limits = [tuple(r) for r in table(spark, folder, "shard_limits").select("limit_name", "max_bytes").orderBy("limit_name").collect()]
    return packed_files(table(spark, folder, "metadata"), "task_id", "file_size", "prompt_zh", limits)


def p2_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Per capacity: shards used, the least possible by bytes alone, the fullest, and files of unknown size."""
    packed = p2_shards(spark, folder)
    shards = packed.groupBy("limit_name", "shard").agg(F.sum("bytes").alias("held"), F.count("*").alias("rows"))
    known = F.col("shard").isNotNull()
    sums = shards.groupBy("limit_name").agg(F.count_if(known).alias("shards"), F.sum("held").alias("bytes"), F.max("held").alias("fullest"), F.coalesce(F.max(F.when(~known, F.col("rows"))), F.lit(0)).alias("unknown_sizes"))
    least = F.ceil(F.col("bytes") / F.col("max_bytes")).alias("least_shards")
    return table(spark, folder, "shard_limits").join(sums, "limit_name", "left").select("limit_name", "max_bytes", "shards", least, "bytes", "fullest", "unknown_sizes")


QUERIES = {"p2_shards": p2_shards, "p2_fill": p2_fill}
SQL: dict[str, str] = {}
