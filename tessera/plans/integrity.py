"""Queries of reference integrity (p3) and of differences between copies (p4), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.differences import differences, digest_copy
from tessera.operators.orphans import orphan_references, state_parents, state_references
from tessera.session import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    refs = state_references(table(spark, folder, "state"))
    parents = state_parents(table(spark, folder, "tasks"), table(spark, folder, "media"))
    return orphan_references(refs, parents).withColumnRenamed("ref_key", "task_key").distinct()


def p3_orphans_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return p3_found(spark, folder).groupBy("ref_field", "finding", "period").agg(F.count("*").alias("orphans"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return differences(
        digest_copy(table(spark, folder, "metadata")), digest_copy(table(spark, folder, "checksums"), "line_no"), "task_id", ["file_name", "sha256"], "metadata", "checksums", right_order="line_no"
    )


def p4_differences_by_field(spark: SparkSession, folder: str) -> DataFrame:
    return p4_found(spark, folder).groupBy("finding").agg(F.count("*").alias("files"))


_P3 = r"""
WITH refs AS (
  SELECT coalesce(nullif(task_id, ''), file_stem) AS task_key, status, loaded_at, strftime(loaded_at, '%Y-%m') AS period,
    nullif(trim(regexp_extract(lower(regexp_replace(output_path, '^\s+|\s+$', '', 'g')), '[^/\\]*$')), '') AS leaf
  FROM state),
files AS (SELECT nullif(trim(regexp_extract(lower(regexp_replace(path, '^\s+|\s+$', '', 'g')), '[^/\\]*$')), '') AS leaf, listed_at, removed_at FROM media),
t AS (SELECT task_id, count(*) FILTER (withdrawn_at IS NULL) AS live, min(loaded_at) FILTER (withdrawn_at IS NULL) AS since FROM tasks GROUP BY 1),
m AS (SELECT leaf, count(*) FILTER (removed_at IS NULL) AS live, min(listed_at) FILTER (removed_at IS NULL) AS since FROM files WHERE leaf IS NOT NULL GROUP BY 1),
found AS (
  SELECT DISTINCT 'state.task_id' AS ref_field, task_key,
    CASE WHEN live IS NULL THEN 'missing' WHEN live = 0 THEN 'deleted' WHEN since > loaded_at THEN 'late' END AS finding, period
  FROM refs LEFT JOIN t ON refs.task_key = t.task_id
  UNION ALL
  SELECT DISTINCT 'state.output_path', task_key,
    CASE WHEN live IS NULL THEN 'missing' WHEN live = 0 THEN 'deleted' WHEN since > loaded_at THEN 'late' END, period
  FROM (SELECT * FROM refs WHERE status = 'done' AND leaf IS NOT NULL) r LEFT JOIN m ON r.leaf = m.leaf)
"""

_P4 = r"""
WITH a AS (
  SELECT *, nullif(regexp_replace(regexp_extract(file_name, '[^/]*$'), '\.[^.]*$', ''), '') AS task_id FROM (
    SELECT DISTINCT regexp_replace(replace(regexp_replace(file_name, '^\s+|\s+$', '', 'g'), '\', '/'), '^(\*\s*)?(\./+)*', '') AS file_name,
      coalesce(lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')), '') AS sha256 FROM metadata)),
b AS (
  SELECT *, nullif(regexp_replace(regexp_extract(file_name, '[^/]*$'), '\.[^.]*$', ''), '') AS task_id FROM (
    SELECT line_no, regexp_replace(replace(regexp_replace(file_name, '^\s+|\s+$', '', 'g'), '\', '/'), '^(\*\s*)?(\./+)*', '') AS file_name,
      coalesce(lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')), '') AS sha256 FROM checksums)
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY line_no DESC) = 1),
both_sides AS (SELECT coalesce(a.task_id, b.task_id) AS task_id, a.task_id IS NOT NULL AS in_a, b.task_id IS NOT NULL AS in_b,
    a.file_name IS DISTINCT FROM b.file_name AS name_differs, a.sha256 IS DISTINCT FROM b.sha256 AS digest_differs
  FROM (SELECT * FROM a WHERE task_id IS NOT NULL) a FULL JOIN (SELECT * FROM b WHERE task_id IS NOT NULL) b ON a.task_id = b.task_id),
found AS (
  SELECT task_id, 'only_metadata' AS finding FROM both_sides WHERE in_a AND NOT in_b
  UNION ALL SELECT task_id, 'only_checksums' FROM both_sides WHERE in_b AND NOT in_a
  UNION ALL SELECT task_id, 'file_name' FROM both_sides WHERE in_a AND in_b AND name_differs
  UNION ALL SELECT task_id, 'sha256' FROM both_sides WHERE in_a AND in_b AND digest_differs)
"""

QUERIES = {"p3_found": p3_found, "p3_orphans_by_month": p3_orphans_by_month, "p4_found": p4_found, "p4_differences_by_field": p4_differences_by_field}

SQL = {
    "p3_found": _P3 + "SELECT * FROM found WHERE finding IS NOT NULL",
    "p3_orphans_by_month": _P3 + "SELECT ref_field, finding, period, count(*) AS orphans FROM found WHERE finding IS NOT NULL GROUP BY ALL",
    "p4_found": _P4 + "SELECT * FROM found",
    "p4_differences_by_field": _P4 + "SELECT finding, count(*) AS files FROM found GROUP BY 1",
}
