"""Progress over a folder of run reports as a stream: new files update the counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas


def report_stream(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """Reports as they arrive, one JSON document per file; files that can't be read give no row.

    A file stream reads each path once: a report that is rewritten in place (from ``running`` to ``done``) is not seen again, and two files on one task are two
    reports. Writers that want every change counted write a new file for it; the last report of each task is the batch reader's (``files.states``)."""
    text = spark.readStream.schema("value STRING").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).format("text").load(f"{folder}/*.json")
    parsed = text.select(F.from_json("value", schemas.STATE).alias("s"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_modification_time").alias("seen_at"))
    key = F.coalesce(F.nullif(F.col("s.task_id"), F.lit("")), F.regexp_replace("_file", r"\.json$", ""))
    return parsed.where("s IS NOT NULL AND coalesce(s.task_id, s.status, s.account) IS NOT NULL").select(key.alias("task_id"), "s.status", "s.account", "seen_at")


def status_stream(reports: DataFrame) -> DataFrame:
    """``status, reports``: each arriving file counts, also several on one task (update mode); the state is one row per status."""
    return reports.groupBy(F.coalesce("status", F.lit("?")).alias("status")).agg(F.count("*").alias("reports"))


def status_by_window(reports: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per status and window of arrival; a window is closed, and its state dropped, once the watermark has passed it."""
    return reports.withWatermark("seen_at", late).groupBy(F.window("seen_at", width).alias("window"), F.coalesce("status", F.lit("?")).alias("status")).agg(F.count("*").alias("reports"))
