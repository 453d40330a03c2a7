"""Splits of the release metadata by prompt (p6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.splits import grouped_splits, spanning_forest
from tessera.session import shared_folder, table


def _tied(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata rows with the numbers of their prompt and of their task's prompts: one row per number of the task."""
    tasks = table(spark, folder, "tasks").select("task_id", "global_id").where("global_id IS NOT NULL").distinct()
    return table(spark, folder, "metadata").select("task_id", "prompt_id").join(tasks.withColumnRenamed("global_id", "task_prompt"), "task_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    ties = _tied(spark, folder).where("prompt_id <> task_prompt").select(F.col("prompt_id").alias("u"), F.col("task_prompt").alias("v")).distinct()
    labels, _ = spanning_forest(ties)
    return labels.where("node <> root").select(F.col("root").alias("group_id"), F.col("node").alias("member_id"))


def p6_forest(spark: SparkSession, folder: str) -> DataFrame:
    """One row: numbers that are tied, their groups, edges of the forest kept, and the groups that the forest alone ties its numbers to."""
    ties = _tied(spark, folder).where("prompt_id <> task_prompt").select(F.col("prompt_id").alias("u"), F.col("task_prompt").alias("v")).distinct()
    labels, forest = spanning_forest(ties, f"{shared_folder(spark)}/p6_forest-{uuid.uuid4().hex}")
    again = spanning_forest(forest)[0]
    one = lambda df, *aggs: df.agg(*aggs).withColumn("_k", F.lit(1))
    counted = one(labels, F.count("*").alias("nodes"), F.count_distinct("root").alias("groups")).join(one(forest, F.count("*").alias("edges")), "_k")
    return counted.join(one(again, F.count_distinct("root").alias("forest_groups")), "_k").drop("_k")


def _splits(spark: SparkSession, folder: str) -> DataFrame:
    targets = [tuple(r) for r in table(spark, folder, "split_targets").select("split_name", "target_share").orderBy("split_name").collect()]
    first = table(spark, folder, "tasks").where("global_id IS NOT NULL").groupBy("task_id").agg(F.min("global_id").alias("task_prompt"))
    metadata = table(spark, folder, "metadata").select("task_id", "prompt_id", "file_name").join(first, "task_id", "left")
    tied = _tied(spark, folder).join(first.withColumnRenamed("task_prompt", "first_prompt"), "task_id")
    ties = tied.select(F.coalesce("prompt_id", "first_prompt").alias("u"), F.col("task_prompt").alias("v"))
    return grouped_splits(metadata.withColumn("number", F.coalesce("prompt_id", "task_prompt")), "number", ties, targets)


def p6_splits(spark: SparkSession, folder: str) -> DataFrame:
    return _splits(spark, folder).select("task_id", "prompt_id", "file_name", "group_key", "split")


def p6_split_shares(spark: SparkSession, folder: str) -> DataFrame:
    counted = _splits(spark, folder).groupBy("split").agg(F.count("*").alias("files"), F.count_distinct("group_key").alias("groups"))
    targets = table(spark, folder, "split_targets").select(F.col("split_name").alias("split"), "target_share")
    whole = F.sum("files").over(Window.partitionBy(F.lit(1)))  # one row per split
    return targets.join(counted, "split", "left").select("split", "files", "groups", F.round(F.col("files") / whole, 4).alias("share"), "target_share")


QUERIES = {"p6_found": p6_found, "p6_splits": p6_splits, "p6_split_shares": p6_split_shares, "p6_forest": p6_forest}

_GROUPS = """WITH RECURSIVE e AS (SELECT DISTINCT m.prompt_id AS u, t.global_id AS v FROM metadata m JOIN tasks t USING (task_id) WHERE m.prompt_id <> t.global_id),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT u AS node, u AS seen FROM b UNION SELECT r.node, b.v FROM r JOIN b ON r.seen = b.u),
g AS (SELECT node, min(seen) AS root FROM r GROUP BY node)"""

SQL = {
    "p6_forest": f"{_GROUPS} SELECT count(*) AS nodes, count(DISTINCT root) AS groups, count(*) - count(DISTINCT root) AS edges, count(DISTINCT root) AS forest_groups FROM g",
    "p6_found": """WITH RECURSIVE e AS (SELECT DISTINCT m.prompt_id AS u, t.global_id AS v FROM metadata m JOIN tasks t USING (task_id) WHERE m.prompt_id <> t.global_id),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT u AS node, u AS seen FROM b UNION SELECT r.node, b.v FROM r JOIN b ON r.seen = b.u)
SELECT min(seen) AS group_id, node AS member_id FROM r GROUP BY node HAVING min(seen) < node""",
}
