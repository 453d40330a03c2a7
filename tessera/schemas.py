"""Declared schemas: no table is inferred. Missing values are NULL; blanks appear only at text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PROMPTS_CSV = "category STRING, shot STRING, raw_prompt STRING"
TASKS = "task_id STRING, account STRING, global_id INT, prompt_id INT, category STRING, raw_prompt STRING, resolution STRING, width INT, height INT, num_frames INT, frame_rate INT"
STATE = "task_id STRING, account STRING, status STRING, video_id STRING, output_path STRING, started_at STRING, completed_at STRING, repaired_at STRING, retries INT, error STRING"
RERUN = "task_id STRING"
MANIFEST = "task_id STRING, new_prompt STRING, task STRUCT<global_id: INT, raw_prompt: STRING>"
PROBE = "task_id STRING, width STRING, height STRING, frame_rate STRING, duration_seconds STRING, num_frames STRING"
PRIOR = "task_id STRING, file_size BIGINT, sha256 STRING"
METADATA = (
    "task_id STRING, account STRING, global_id INT, prompt_id INT, shot_id INT, category STRING, resolution STRING, prompt_zh STRING, enhanced_prompt STRING, negative_prompt STRING, "
    "requested_width INT, requested_height INT, actual_width INT, actual_height INT, num_frames INT, frame_rate INT, duration_seconds DOUBLE, actual_frame_rate DOUBLE, "
    "actual_duration_seconds DOUBLE, actual_num_frames INT, media_metadata_source STRING, source_model STRING, generation_api STRING, video_id STRING, status STRING, started_at STRING, "
    "completed_at STRING, retries INT, repair_stage STRING, file_name STRING, shard STRING, file_size BIGINT, sha256 STRING"
)
PROMPTS = "global_id INT, prompt_id INT, shot_id INT, category STRING, prompt_zh STRING, was_policy_rewritten BOOLEAN, prompt_variant_count INT, prompt_variants_json STRING, task_ids_json STRING"
SHARD_INDEX = "shard STRING, num_videos INT, size_bytes BIGINT, sha256 STRING, first_task_id STRING, last_task_id STRING"
STATS = "task_id STRING, account STRING, status STRING, video_id STRING, output_path STRING, started_at STRING, completed_at STRING, retries INT, error STRING"
VIOLATIONS = "rule_id STRING, severity STRING, subject STRING, detail STRING"

# The generation profiles (requested size, frames, rate; encoded size, duration, least bytes of a plausible file).
PROFILES = (
    ("1080p", 1920, 1080, 169, 24, 1920, 1088, 7.041667, 150000),
    ("720p", 1152, 768, 409, 24, 1088, 832, 17.041667, 300000),
    ("480p", 640, 480, 961, 24, 704, 512, 40.041667, 500000),
)
PROFILE_SCHEMA = "resolution STRING, width INT, height INT, num_frames INT, frame_rate INT, encoded_w INT, encoded_h INT, duration_s DOUBLE, min_bytes BIGINT"
ACCOUNTS = tuple("ABCDEFGHIJ")


def columns(schema: str) -> list[str]:
    """Column names of a schema string, in order."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fieldNames()


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROFILES), PROFILE_SCHEMA)
