"""Validation of a project before release and of a staged release, as tables of violations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import rules
from tessera.operators.profiling import nested_counts
from tessera.operators.reconcile import cardinalities, within


@dataclass(frozen=True)
class Shape:
    """What a complete release looks like; None is not checked."""

    rows: int | None = 9000
    prompts: int | None = 3000
    per_prompt: int = 3
    shots: tuple[int, ...] = tuple(range(1, 11))
    per_shot: int | None = 900
    per_profile: int | None = 3000
    source: str = "ffprobe_cache"


def project_violations(tasks: DataFrame, states: DataFrame, media: DataFrame, least_bytes: int = 1024, done: str = "done") -> DataFrame:
    """Tasks without report or file, not done, with a file below ``least_bytes``; repeated tasks; reports and files nobody asked for (warnings).

    One pass: the three sides are stacked and reduced to a row per ``task_id`` (map-side first), whose violations are exploded. Of several reports or files
    of a task the greatest status and the smallest length count; a null id is an id of its own."""
    none = lambda kind: F.lit(None).cast(kind)
    stacked = (
        tasks.select("task_id", F.lit("t").alias("side"), none("string").alias("status"), none("bigint").alias("length"))
        .unionByName(states.select("task_id", F.lit("s").alias("side"), "status", none("bigint").alias("length")))
        .unionByName(media.select("task_id", F.lit("m").alias("side"), none("string").alias("status"), F.coalesce(F.col("length").cast("bigint"), F.lit(0)).alias("length")))
    )
    of = lambda k: F.count_if(F.col("side") == k).alias(k)
    held = stacked.groupBy("task_id").agg(of("t"), of("s"), of("m"), F.max("status").alias("status"), F.min("length").alias("length"))
    wanted, lacks = F.col("t") > 0, lambda k: F.col(k) == 0
    one = lambda when, rule, detail, severity=rules.ERROR: F.when(when, F.struct(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), (F.lit(detail) if isinstance(detail, str) else detail.cast("string")).alias("detail")))
    found = F.array_compact(
        F.array(
            one(F.col("t") > 1, "duplicate_task", F.concat(F.lit("rows: "), F.col("t").cast("string"))), one(wanted & lacks("s"), "missing_state", "no report"), one(wanted & lacks("m"), "missing_video", "no file"),
            one(wanted & ~F.col("status").eqNullSafe(F.lit(done)), "not_done", F.coalesce("status", F.lit("?"))), one(wanted & (F.col("length") < least_bytes), "small_or_empty", F.col("length")),
            one(~wanted & ~lacks("s"), "extra_state", "state of no task", rules.WARN), one(~wanted & ~lacks("m"), "extra_video", "video of no task", rules.WARN),
        )
    )
    return held.select(F.col("task_id").alias("subject"), F.explode(found).alias("v")).select("v.rule_id", "v.severity", "subject", "v.detail")


def as_map(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """A small table of two columns as one row with a map, in order of the key; an empty table gives an empty map."""
    pairs = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(key).cast("string"), F.lit("?")).alias("k"), F.col(value).alias("v"))), lambda a, b: F.when(a["k"] < b["k"], -1).otherwise(1))
    return df.agg(F.map_from_entries(pairs).alias(name))


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Tables of one row each as one row."""
    out = None
    for r in rows:
        r = r.withColumn("_k", F.lit(1))
        out = r if out is None else out.join(r, "_k")
    return out.drop("_k")


def problem_maps(found: DataFrame) -> list[DataFrame]:
    """Violations by rule: their numbers, and the first few subjects."""
    few = rules.samples(found).groupBy("rule_id").agg(F.sum("violations").alias("n"), F.flatten(F.collect_list("subjects")).alias("subjects"))
    return [as_map(few, "rule_id", "n", "problems"), as_map(few, "rule_id", "subjects", "samples")]


def project_report(tasks: DataFrame, states: DataFrame, media: DataFrame, found: DataFrame) -> DataFrame:
    """One row: ``counts``, tasks ``by_account`` and profile and ``by_resolution``, ``problems`` (violations by rule) with ``samples``, and ``ok``."""
    keys = cardinalities(tasks, media, ["task_id"]).select(F.col("left_keys").alias("tasks"), F.col("right_keys").alias("mp4"), F.col("both").alias("task_mp4"))
    counts = side_by_side(keys, states.agg(F.count("*").alias("states")), within(media, tasks, ["task_id"]).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("video_size_bytes")))
    counts = counts.select(F.struct("tasks", "states", "mp4", "task_mp4", "video_size_bytes").alias("counts"))
    by_account = as_map(nested_counts(tasks, "account", "resolution"), "account", "counts", "by_account")
    by_resolution = as_map(tasks.groupBy("resolution").agg(F.count("*").alias("n")), "resolution", "n", "by_resolution")
    return side_by_side(counts, by_account, by_resolution, *problem_maps(found), rules.verdict(found).select("ok"))


def release_report(metadata: DataFrame, members: DataFrame, checksums: DataFrame, found: DataFrame, source: str) -> DataFrame:
    """One row: ``ok, errors``, counts of a staged release, ``profile_counts``, ``problems`` and ``samples``."""
    counts = metadata.agg(F.count("*").alias("num_videos"), F.count_distinct("global_id").alias("num_prompts"), F.count_distinct("shard").alias("num_shards"), F.count_if(F.col("media_metadata_source") == source).alias("full_media_probe_rows"))
    profile = as_map(metadata.groupBy("resolution").agg(F.count("*").alias("n")), "resolution", "n", "profile_counts")
    return side_by_side(rules.verdict(found), counts, members.agg(F.count("*").alias("tar_video_count")), checksums.agg(F.count("*").alias("checksums_rows")), profile, *problem_maps(found))


MEASURED = (("actual_width", "encoded_w"), ("actual_height", "encoded_h"), ("actual_num_frames", "num_frames"), ("actual_frame_rate", "frame_rate"), ("actual_duration_seconds", "duration_s"))


def release_violations(metadata: DataFrame, prompts: DataFrame, profiles: DataFrame, shape: Shape = Shape(), csv_rows: int | None = None) -> DataFrame:
    """Rules of the tables of a release: counts, unique tasks, prompt groups, shots, profiles, measured values, their source, places and digests."""
    known = profiles.select("resolution", *[F.col(b).cast("double").alias(b) for _, b in MEASURED])
    values = metadata.select("task_id", "resolution", *[F.col(a).cast("double").alias(a) for a, _ in MEASURED])
    parts = [rules.unique_key(metadata, "unique_task", "task_id"), rules.group_shape(metadata, "prompt_groups", "global_id", shape.prompts, shape.per_prompt), rules.key_domain(metadata, "shots", "shot_id", shape.shots, shape.per_shot)]
    parts += [rules.matches_lookup(values, "measured_values", "task_id", known, "resolution", MEASURED), rules.all_equal(metadata, "media_source", "task_id", "media_metadata_source", shape.source)]
    parts += [rules.key_domain(metadata, "profiles", "resolution", [r["resolution"] for r in profiles.select("resolution").collect()], shape.per_profile), rules.not_blank(metadata, "located", "task_id", ["file_name", "shard"]), rules.not_blank(metadata, "digest", "task_id", ["sha256"])]
    if shape.rows is not None:
        parts.append(rules.row_count(metadata, "metadata_rows", shape.rows))
    if shape.prompts is not None:
        parts.append(rules.row_count(prompts, "prompt_rows", shape.prompts))
    if csv_rows is not None:
        n = metadata.agg(F.count("*").alias("n")).where(F.col("n") != csv_rows)
        parts.append(rules.violations(n, "csv_rows", F.lit("rows"), F.concat(F.col("n").cast("string"), F.lit(f", in the CSV {csv_rows}"))))
    return rules.together(*parts)


def shard_violations(metadata: DataFrame, index: DataFrame, archives: DataFrame, members: DataFrame, checksums: DataFrame) -> DataFrame:
    """Rules of the shards: named by both metadata and index, there, of the size in the index, with the members the metadata says, and digests as in the checksum file.

    archives: ``shard, length`` of files that are there; members: ``shard, file_name``."""
    shards = metadata.select("shard").distinct()
    held = index.select("shard", "size_bytes").join(archives.select("shard", "length"), "shard", "left")
    off_size = rules.violations(held.where("length <> size_bytes"), "shard_size", F.col("shard"), F.concat(F.col("length").cast("string"), F.lit(" / "), F.col("size_bytes").cast("string")))
    gone = rules.violations(held.where("length IS NULL"), "shard_file", F.col("shard"), "no file")
    name = lambda df: df.select(F.concat_ws(" ", "shard", "file_name").alias("member"))
    there = metadata.join(archives.select("shard"), "shard", "left_semi")
    return rules.together(
        rules.same_keys(shards, index, "shard_set", "shard", names=("metadata", "index")), gone, off_size, rules.same_keys(name(there), name(members), "shard_members", "member", names=("metadata", "archive")),
        rules.same_values(metadata, checksums, "checksums", "file_name", "sha256"),
    )


def outputs_missing(states: DataFrame, media: DataFrame, done: str = "done") -> DataFrame:
    """Finished reports whose recorded path is blank or has no file: ``task_id, output_path``. Paths are compared by their last part."""
    leaf = lambda c: F.nullif(F.element_at(F.split(F.translate(F.btrim(c), "\\", "/"), "/"), -1), F.lit(""))
    wanted = states.where(F.col("status") == done).select("task_id", "output_path", leaf(F.col("output_path")).alias("_leaf"))
    return wanted.join(media.select(leaf(F.col("path")).alias("_leaf")).distinct(), "_leaf", "left_anti").select("task_id", "output_path")

