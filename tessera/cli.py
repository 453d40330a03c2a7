"""``python -m tessera.cli <command>``: the commands of the pipeline over folders of files."""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.scalars import first_part, parse_size, percent
from tessera.operators import profiling, rules
from tessera.operators.keys import DuplicateKeys, unique
from tessera.operators.packing import next_fit
from tessera.operators.reconcile import refreshed
from tessera.plans import checks, release, tasks as task_plan
from tessera.session import cut
from tessera.sources import containers, files, sinks

# Files of a release that go along with its shards.
SIDE_FILES = ("validation_report.json", "prompts.csv", "build_metadata.log")


def project_root(folders: Sequence[str] = ("tasks", "state", "output"), inner: Sequence[str] = ("tasks",)) -> str:
    """The folder a command works in: this one if it holds all ``folders``, else its ``worker`` if that holds ``inner``, else this one."""
    holds = lambda at, names: all(os.path.exists(os.path.join(at, n)) for n in names)
    return "worker" if not holds(".", folders) and holds("worker", inner) else "."


RELEASED = ("release/metadata.jsonl",)


def enhancer(spec: str | None) -> Callable:
    """A function Column -> struct ``enhanced, negative``, named as ``module:function``; without one texts stay as they are."""
    if not spec:
        return release.Config().enhance
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name or "enhance")


def generate_tasks(spark: SparkSession, csv: str, out: str) -> DataFrame:
    made = cut(task_plan.task_table(files.prompts_csv(spark, csv), schemas.profiles(spark)))
    unique(made, "task_id")
    sinks.tasks_by_account(made, out)
    return task_plan.load_by_account(made, [p[0] for p in schemas.PROFILES])


def build_metadata(spark: SparkSession, root: str, out: str, sha256: bool = True, live_probe: bool = False, probe_cache: str | None = None, reuse: str | None = None, enhance: str | None = None, source_model: str = "", generation_api: str = "") -> DataFrame:
    made = cut(files.tasks(spark, f"{root}/tasks"))
    reports = cut(files.states(spark, f"{root}/state")[0])
    media = cut(files.media_listing(spark, f"{root}/output"))
    gaps = release.incomplete(made, reports, media)
    some = gaps.orderBy("task_id").limit(20).collect()
    if some:
        raise release.Incomplete(", ".join(f"{r['task_id']}: {r['problem']}" for r in some))
    profiles = schemas.profiles(spark)
    stages = release.repair_stages(files.key_set(spark, f"{root}/rerun_policy16_manifest.jsonl"), files.key_set(spark, files.newest(spark, f"{root}/rerun_99_state_backup_*.jsonl")))
    cache = files.probe_cache(spark, probe_cache)
    live = files.probe_records(containers.probed(media.join(cache, "task_id", "left_anti"))) if live_probe else None
    prior = files.prior_metadata(spark, reuse if sha256 else None)  # without digests none is taken over either
    digests = cut(release.reused_digests(media, prior, containers.digests if sha256 else None))
    config = release.Config(source_model, generation_api, enhancer(enhance))
    table = cut(release.metadata(made, reports, digests, release.measured(made, cache, live, profiles), stages, config))
    prompts = release.prompt_table(table, files.prompt_overrides(spark, f"{root}/rerun_policy16_manifest.jsonl"))
    sinks.json_table(table, f"{out}/metadata.jsonl", ["task_id"])
    sinks.csv_table(table, f"{out}/metadata.csv", schemas.columns(schemas.METADATA), ["task_id"])
    sinks.csv_table(prompts, f"{out}/prompts.csv", schemas.columns(schemas.PROMPTS), ["global_id"])
    sinks.checksum_lines(table, f"{out}/checksums.sha256")
    return digests.agg(F.count("*").alias("files"), F.count_if("reused").alias("reused_digests"))


def _release(spark: SparkSession, folder: str) -> DataFrame:
    return files.json_lines(spark, f"{folder}/metadata.jsonl", schemas.METADATA)


def make_shards(spark: SparkSession, root: str, dest: str, limit: str = "2g", force: bool = False, refresh_only: bool = False) -> DataFrame:
    source = cut(unique(_release(spark, f"{root}/release"), "task_id"))
    if refresh_only:
        staged = cut(_release(spark, dest))
        index = files.shard_index(spark, f"{dest}/shard_index.json")
        table = cut(refreshed(source, staged, "task_id", ["file_name", "shard"]))
    else:
        sinks.prepare(spark, dest, force)
        media = files.media_listing(spark, f"{root}/output").select("task_id", "path", "length")
        missing = source.select("task_id").join(media, "task_id", "left_anti").orderBy("task_id").limit(20).collect()
        if missing:
            raise release.Incomplete(", ".join(r["task_id"] for r in missing))
        order = source.select("task_id", "account", "global_id", "resolution").join(media, "task_id")
        packed = cut(next_fit(order, ["task_id"], "length", parse_size(limit)))
        index = sinks.tar_shards(packed, dest)
        table = cut(sinks.located(source, packed))
        sinks.shard_index(spark, index, f"{dest}/shard_index.json")
    sinks.json_table(table, f"{dest}/metadata.jsonl", ["task_id"])
    sinks.csv_table(table, f"{dest}/metadata.csv", schemas.columns(schemas.METADATA), ["task_id"])
    sinks.parquet_table(table, f"{dest}/metadata.parquet")
    sinks.checksum_lines(table, f"{dest}/checksums.sha256")
    sinks.copy_side_files(spark, f"{root}/release", dest, SIDE_FILES)
    return index


def validate_dataset(spark: SparkSession, root: str, min_size: int = 1024, out: str | None = None) -> dict:
    """The report of a project; all violations are written beside it. A task without an id or in several lines raises DuplicateKeys."""
    made, reports, media = cut(files.tasks(spark, f"{root}/tasks", strict=True)), cut(files.states(spark, f"{root}/state")[0]), cut(files.media_listing(spark, f"{root}/output"))
    found = cut(checks.project_violations(made, reports, media, min_size))
    at = out or f"{root}/release/validation_report.json"
    sinks.json_table(found, f"{at}.violations")
    return sinks.report(spark, at, checks.project_report(made, reports, media, found).withColumn("root", F.lit(root)))


def validate_staging(spark: SparkSession, staging: str, output: str | None = None, shape: checks.Shape = checks.Shape()) -> dict:
    """The report of a staged release; all violations are written beside it."""
    table = cut(_release(spark, staging))
    prompts = cut(spark.read.schema(schemas.PROMPTS).option("header", True).option("multiLine", True).option("escape", '"').csv(f"{staging}/prompts.csv"))
    index = files.shard_index(spark, f"{staging}/shard_index.json")
    archives = files.listing(spark, [f"{staging}/shards"], ".tar").select(F.regexp_extract("path", r"(shards/[^/]+)$", 1).alias("shard"), "path", "length")
    members = cut(containers.tar_members(spark, files.matches(spark, f"{staging}/shards/*.tar")).select(F.regexp_extract("archive", r"(shards/[^/]+)$", 1).alias("shard"), F.col("member").alias("file_name")))
    checksums = cut(files.checksum_manifest(spark, f"{staging}/checksums.sha256"))
    csv_rows = files.csv_rows(spark, f"{staging}/metadata.csv")
    found = checks.release_violations(table, prompts, schemas.profiles(spark), shape, csv_rows)
    found = cut(rules.together(found, checks.shard_violations(table, index, cut(archives), members, checksums)))
    at = output or f"{staging}/staging_validation.json"
    sinks.json_table(found, f"{at}.violations")
    parts = files.sizes(spark, f"{staging}/metadata.parquet")
    extra = {"metadata_csv_rows": F.lit(csv_rows), "prompts_csv_rows": F.lit(prompts.count()), "parquet_exists": F.lit(bool(parts)), "parquet_size_bytes": F.lit(sum(parts))}
    return sinks.report(spark, at, checks.release_report(table, members, checksums, found, shape.source).withColumns(extra))


def summarize(spark: SparkSession, root: str, out: str | None = None, shown: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Progress over all, by account, and the first failures. Every report that can be read counts, also repeated ones of a task."""
    reports = cut(files.reports(spark, f"{root}/state")[0])
    made = files.account_lines(spark, f"{root}/tasks")
    if out:
        sinks.csv_table(reports.orderBy("_file"), out, schemas.columns(schemas.STATS))
    planned = made.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("planned"))
    overall = checks.side_by_side(reports.agg(F.count("*").alias("touched"), F.count_if(F.col("status") == "done").alias("done")), planned)
    whole = F.when(F.col("planned") > 0, F.col("planned")).otherwise(F.col("touched"))
    overall = overall.withColumns({"untouched": F.greatest(F.lit(0), F.col("planned") - F.col("touched")), "percent_done": percent(F.col("done"), whole)})
    statuses = ["done", "running", "failed", "permanent_failed"]
    by_account = profiling.matrix(reports.withColumn("account", first_part(files.report_key())), "account", "status", statuses, "other")
    full = made.join(by_account, "account", "full_outer").select("account", F.coalesce("lines", "total").alias("tasks"), *[F.coalesce(c, F.lit(0)).alias(c) for c in (*statuses, "other", "total")])
    full = full.withColumns({"pending": F.greatest(F.col("tasks") - F.col("total"), F.lit(0)), "percent_done": percent(F.col("done"), F.col("tasks"))})
    failed = reports.where(F.col("status").isin("failed", "permanent_failed")).orderBy("task_id").limit(shown).select("task_id", "status", "error")
    return overall, full.orderBy("account"), failed


def verify(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Integrity of every file, sizes of the sound ones by profile, and finished reports without their file."""
    media = cut(files.media_listing(spark, f"{root}/output"))
    sound = cut(containers.integrity(containers.with_boxes(media, "path"), schemas.profiles(spark)))
    sizes = profiling.size_distribution(sound.where("ok"), "resolution", "length")
    return sound, sizes, checks.outputs_missing(files.states(spark, f"{root}/state", "worker_%")[0], media)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> None:
        c = sub.add_parser(name)
        for names, kw in options:
            c.add_argument(*names.split(), **kw)

    root, released = ("--root", {"default": project_root()}), ("--root", {"default": project_root((*RELEASED, "output"), RELEASED)})
    command("generate-tasks", ("--csv", {"required": True}), ("--out", {"required": True}))
    command("build-metadata", root, ("--release-dir", {}), ("--no-sha256", {"action": "store_true"}), ("--ffprobe", {"action": "store_true"}), ("--probe-cache", {}), ("--reuse-checksums-from", {}), ("--enhancer", {}), ("--source-model", {"default": ""}), ("--generation-api", {"default": ""}))
    command("make-shards", released, ("--dest", {"required": True}), ("--max-shard-size", {"default": "2g"}), ("--force", {"action": "store_true"}), ("--refresh-metadata-only", {"action": "store_true"}))
    command("validate-dataset", root, ("--min-size", {"type": int, "default": 1024}), ("--out", {}))
    command("validate-staging", ("--staging", {"required": True}), ("--output", {}))
    command("summarize", root, ("--out", {}))
    command("verify", root)
    command("probe-videos", ("input_dir", {}), ("output_csv", {}))
    command("inspect-metadata", ("parquet", {}))
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tessera {a.command}").getOrCreate()
    if a.command == "generate-tasks":
        generate_tasks(spark, a.csv, a.out).orderBy("account").show()
    elif a.command == "build-metadata":
        build_metadata(spark, a.root, a.release_dir or f"{a.root}/release", not a.no_sha256, a.ffprobe, a.probe_cache, a.reuse_checksums_from, a.enhancer, a.source_model, a.generation_api).show()
    elif a.command == "make-shards":
        make_shards(spark, a.root, a.dest, a.max_shard_size, a.force, a.refresh_metadata_only).orderBy("shard").show(50, False)
    elif a.command in ("validate-dataset", "validate-staging"):
        try:
            said = validate_dataset(spark, a.root, a.min_size, a.out) if a.command == "validate-dataset" else validate_staging(spark, a.staging, a.output)
        except DuplicateKeys as e:
            print(f"task_id: {e}", file=sys.stderr)
            return 1
        print(json.dumps(said, ensure_ascii=False, indent=2))
        return int(not said["ok"])
    elif a.command == "summarize":
        for df in summarize(spark, a.root, a.out):
            df.show(50, False)
    elif a.command == "verify":
        sound, sizes, lost = verify(spark, a.root)
        sound.where("NOT ok").orderBy("task_id").show(30, False)
        sizes.show()
        lost.orderBy("task_id").show(20, False)
    elif a.command == "probe-videos":
        probe = lambda path, b=os.environ.get("FFPROBE_BIN", "ffprobe"): containers.ffprobe(path, b)
        sinks.csv_table(containers.probed(files.media_listing(spark, a.input_dir), probe), a.output_csv, order=["task_id"])
    else:
        df = spark.read.parquet(a.parquet)
        df.limit(5).show()
        print(df.count())
        profiling.value_counts(df, "resolution").orderBy("value").show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
