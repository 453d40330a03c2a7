"""Tasks, run reports and files to release metadata, prompts and shards."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.scalars import duration, json_array, owner
from tessera.operators.keys import overlay
from tessera.operators.profiling import group_variants


class Incomplete(ValueError):
    """Tasks without a finished report or without a file."""


@dataclass(frozen=True)
class Config:
    """Constants of a release. enhance: prompt to a struct ``enhanced, negative``."""

    source_model: str = ""
    generation_api: str = ""
    enhance: Callable[[Column], Column] = field(default=lambda c: F.struct(c.alias("enhanced"), F.lit("").alias("negative")))


def repair_stages(policy: DataFrame, rerun: DataFrame) -> DataFrame:
    """``task_id, stage``: a task of the policy manifest counts as such, whatever else it is."""
    return overlay([policy.select("task_id", F.lit("policy16_prompt_rewrite").alias("stage")).distinct(), rerun.select("task_id", F.lit("rerun_99").alias("stage")).distinct()], ["task_id"])


def stage_of(stage: Column, repaired_at: Column) -> Column:
    return F.coalesce(stage, F.when(F.coalesce(repaired_at, F.lit("")) != "", F.lit("state_repair")), F.lit("initial"))


def incomplete(tasks: DataFrame, states: DataFrame, media: DataFrame, done: str = "done") -> DataFrame:
    """``task_id, problem``: every task without a file, and every one without a report that is done."""
    held = tasks.select("task_id").join(states.select("task_id", "status"), "task_id", "left").join(media.select("task_id", F.lit(True).alias("_file")), "task_id", "left")
    found = F.array_compact(F.array(F.when(F.col("_file").isNull(), F.lit("no file")), F.when(~F.col("status").eqNullSafe(F.lit(done)), F.concat(F.lit("status "), F.coalesce("status", F.lit("?"))))))
    return held.select("task_id", F.explode(found).alias("problem"))


def measured(tasks: DataFrame, cache: DataFrame, live: DataFrame | None, profiles: DataFrame) -> DataFrame:
    """``task_id`` and the values measured of its file: the cached row if there is one, even a blank one, else the live row, else what the profile says; with the name of the source."""
    columns = ("width", "height", "frame_rate", "duration_seconds", "num_frames")
    row = lambda df, n: df.select("task_id", F.struct(*columns).alias(n))
    nominal = profiles.select("resolution", F.struct(F.col("encoded_w").alias("width"), F.col("encoded_h").alias("height"), F.lit(None).cast("double").alias("rate")).alias("_p"))
    df = tasks.select("task_id", "resolution", "num_frames", "frame_rate").join(row(cache, "_c"), "task_id", "left")
    df = df.join(row(live, "_l"), "task_id", "left") if live is not None else df.withColumn("_l", F.lit(None).cast(df.schema["_c"].dataType))
    df = df.join(F.broadcast(nominal), "resolution", "left")
    expected = F.struct(F.col("_p.width").alias("width"), F.col("_p.height").alias("height"), F.col("frame_rate").cast("double").alias("frame_rate"), duration(F.col("num_frames"), F.col("frame_rate")).alias("duration_seconds"), F.col("num_frames"))
    taken = F.coalesce(F.col("_c"), F.col("_l"), expected)
    source = F.when(F.col("_c").isNotNull(), "ffprobe_cache").when(F.col("_l").isNotNull(), "ffprobe").otherwise("observed_resolution_profile")
    return df.select("task_id", taken.alias("m"), source.alias("media_metadata_source"))


def reused_digests(media: DataFrame, prior: DataFrame, digests: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """``task_id, path, length, sha256, reused``: the digest of the earlier release where the size is the same and it has 64 characters; only the other files are read (none without ``digests``)."""
    known = prior.select("task_id", F.col("file_size").alias("_size"), F.col("sha256").alias("_sha"))
    held = media.select("task_id", "path", "length").join(known, "task_id", "left").withColumn("reused", F.coalesce((F.col("_size") == F.col("length")) & (F.length("_sha") == 64), F.lit(False)))
    old = held.where("reused").select("task_id", "path", "length", F.col("_sha").alias("sha256"), "reused")
    new = held.where("NOT reused").select("task_id", "path", "length")
    new = digests(new) if digests else new.withColumn("sha256", F.lit(None).cast("string"))
    return old.unionByName(new.withColumn("reused", F.lit(False)))


def metadata(tasks: DataFrame, states: DataFrame, files: DataFrame, values: DataFrame, stages: DataFrame, config: Config) -> DataFrame:
    """The release metadata, one row per task. All inputs have a unique ``task_id``; files: ``path, length, sha256``; values: as from ``measured``.

    Run reports without fields give nulls (retries 0). Every join is on the task, so the sides are shuffled once and stay in place."""
    report = states.select("task_id", *[F.col(c).alias(f"s_{c}") for c in ("status", "video_id", "started_at", "completed_at", "repaired_at", "retries")])
    df = tasks.join(report, "task_id", "left").join(files.select("task_id", F.col("length").alias("file_size"), "sha256"), "task_id", "left").join(values, "task_id", "left").join(stages, "task_id", "left")
    e = config.enhance(F.col("raw_prompt"))
    df = df.withColumn("_e", e)
    out = {
        "account": owner(F.col("account"), F.col("task_id")), "global_id": F.col("global_id"), "prompt_id": F.col("global_id"), "shot_id": F.col("prompt_id"), "prompt_zh": F.col("raw_prompt"), "enhanced_prompt": F.col("_e.enhanced"),
        "negative_prompt": F.col("_e.negative"), "requested_width": F.col("width"), "requested_height": F.col("height"), "actual_width": F.col("m.width"), "actual_height": F.col("m.height"),
        "duration_seconds": duration(F.col("num_frames"), F.col("frame_rate")), "actual_frame_rate": F.col("m.frame_rate"), "actual_duration_seconds": F.col("m.duration_seconds"), "actual_num_frames": F.col("m.num_frames"),
        "source_model": F.lit(config.source_model), "generation_api": F.lit(config.generation_api), "video_id": F.col("s_video_id"), "status": F.col("s_status"), "started_at": F.col("s_started_at"), "completed_at": F.col("s_completed_at"),
        "retries": F.coalesce("s_retries", F.lit(0)), "repair_stage": stage_of(F.col("stage"), F.col("s_repaired_at")), "file_name": F.concat(F.lit("output/"), F.col("task_id"), F.lit(".mp4")), "shard": F.lit(None).cast("string"),
    }
    return df.select(*[out.get(c, F.col(c)).alias(c) for c in schemas.columns(schemas.METADATA)])


def prompt_table(metadata_: DataFrame, overrides: DataFrame) -> DataFrame:
    """One row per prompt number: shot and category of its lowest task, its text (the replacement if there is one), its wordings and tasks as JSON."""
    groups = group_variants(metadata_, "global_id", "task_id", "prompt_zh", ["shot_id", "category", "prompt_zh"])
    joined = groups.join(overrides.select("global_id", "prompt"), "global_id", "left")
    return joined.select(
        "global_id", F.col("global_id").alias("prompt_id"), "shot_id", "category", F.coalesce("prompt", "prompt_zh").alias("prompt_zh"), F.col("prompt").isNotNull().alias("was_policy_rewritten"),
        F.col("variant_count").cast("int").alias("prompt_variant_count"), json_array(F.col("variants")).alias("prompt_variants_json"), json_array(F.col("keys")).alias("task_ids_json"),
    )
