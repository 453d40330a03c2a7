"""Prompts with small edits (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.lookalikes import canonical_texts
from tessera.llm.near_duplicates import near_duplicates
from tessera.llm.queries_p1 import form_sql
from tessera.llm.splits import spanning_forest
from tessera.session import cut, table

#: Characters of a gram and least similarity, as the problem states them.
N, THRESHOLD = 3, 0.65


def _classes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    members, pairs = near_duplicates(table(spark, folder, "tasks"), "global_id", "raw_prompt", N, THRESHOLD, canonical_texts)
    return cut(members), pairs


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    members, pairs = _classes(spark, folder)
    several = members.groupBy("tid").agg(F.count("*").alias("n")).where("n > 1").select("tid")
    links = pairs.select("tid_a", "tid_b").unionByName(several.select(F.col("tid").alias("tid_a"), F.col("tid").alias("tid_b")))
    a, b = (members.select(F.col("global_id").alias(f"g_{s}"), F.col("tid").alias(f"tid_{s}")) for s in "ab")
    ids = links.join(a, "tid_a").join(b, "tid_b").where("g_a <> g_b")
    return ids.select(F.least("g_a", "g_b").alias("global_id_a"), F.greatest("g_a", "g_b").alias("global_id_b")).distinct()


def p5_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per prompt number and class of equal prompts, with the number of classes it is similar to."""
    members, pairs = _classes(spark, folder)
    ends = pairs.select(F.explode(F.array("tid_a", "tid_b")).alias("tid")).groupBy("tid").agg(F.count("*").alias("links"))
    smallest = members.groupBy("tid").agg(F.min("global_id").alias("class_id"))
    return members.join(smallest, "tid").join(ends, "tid", "left").select("global_id", "class_id", F.coalesce("links", F.lit(0)).alias("links"))


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The groups of prompt numbers that are similar, directly or through others: ``group_id`` (the smallest)``, global_id``; numbers alike to no other are left out."""
    members, pairs = _classes(spark, folder)
    named = cut(members.groupBy("tid").agg(F.min("global_id").alias("first")))
    end = lambda s: named.select(F.col("tid").alias(f"tid_{s}"), F.col("first").alias("u" if s == "a" else "v"))
    between = pairs.join(end("a"), "tid_a").join(end("b"), "tid_b").select("u", "v")
    inside = members.join(named, "tid").select(F.col("first").alias("u"), F.col("global_id").alias("v"))
    labels = spanning_forest(between.unionByName(inside).where("u <> v"))[0]
    return labels.select(F.col("root").alias("group_id"), F.col("node").alias("global_id"))


QUERIES = {"p5_found": p5_found, "p5_classes": p5_classes, "p5_groups": p5_groups}
_PAIRS = f"""f AS (SELECT raw_prompt, {form_sql()} AS text FROM (SELECT DISTINCT raw_prompt FROM tasks WHERE raw_prompt IS NOT NULL)),
c AS (SELECT text, row_number() OVER (ORDER BY text) AS tid FROM (SELECT DISTINCT text FROM f)),
m AS (SELECT DISTINCT global_id, tid FROM tasks JOIN f USING (raw_prompt) JOIN c USING (text) WHERE global_id IS NOT NULL),
g AS (SELECT DISTINCT tid, unnest(list_transform(range(1, length(text) - {N - 2}), lambda i: substr(text, i, {N}))) AS gram FROM c WHERE length(text) >= {N}),
z AS (SELECT tid, count(*) AS size FROM g GROUP BY 1),
o AS (SELECT a.tid AS x, b.tid AS y, count(*) AS n FROM g a JOIN g b ON a.gram = b.gram AND a.tid < b.tid GROUP BY 1, 2),
p AS (SELECT x, y FROM o JOIN z a ON a.tid = x JOIN z b ON b.tid = y WHERE n >= {THRESHOLD} * (a.size + b.size - n) UNION ALL SELECT tid, tid FROM c),
found AS MATERIALIZED (SELECT DISTINCT least(a.global_id, b.global_id) AS global_id_a, greatest(a.global_id, b.global_id) AS global_id_b FROM p JOIN m a ON a.tid = x JOIN m b ON b.tid = y WHERE a.global_id <> b.global_id)"""

SQL = {
    "p5_classes": f"""WITH {_PAIRS}, k AS (SELECT tid, min(global_id) AS class_id FROM m GROUP BY 1),
l AS (SELECT tid, count(*) AS links FROM (SELECT x AS tid FROM p WHERE x <> y UNION ALL SELECT y FROM p WHERE x <> y) GROUP BY 1)
SELECT global_id, class_id, coalesce(links, 0) AS links FROM m JOIN k USING (tid) LEFT JOIN l USING (tid)""",
    "p5_found": f"WITH {_PAIRS} SELECT * FROM found",
    "p5_groups": f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT global_id_a AS u, global_id_b AS v FROM found UNION SELECT global_id_b, global_id_a FROM found),
r AS (SELECT u AS node, u AS seen FROM e UNION SELECT r.node, e.v FROM r JOIN e ON r.seen = e.u)
SELECT min(seen) AS group_id, node AS global_id FROM r GROUP BY node""",
}
