"""Table sources: prompts, tasks, states, caches, manifests. Every reader declares its schema."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators.keys import last_wins, numbered, unique
from tessera.session import ship


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def matches(spark: SparkSession, glob: str) -> list[str]:
    """Paths that match, by name."""
    p, fs = _path(spark, glob)
    return sorted(str(s.getPath()) for s in (fs.globStatus(p) or []))


def sizes(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of the data files of a written table; none if it isn't there."""
    p, fs = _path(spark, folder)
    return [s.getLen() for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))] if fs.exists(p) else []


def newest(spark: SparkSession, glob: str) -> str | None:
    """The last path by name (not by time); None if there is none."""
    found = matches(spark, glob)
    return found[-1] if found else None


def prompts_csv(spark: SparkSession, path: str) -> DataFrame:
    """``global_id, category, prompt_id, raw_prompt`` of a prompt file whose columns are known by place.

    Quoted newlines are data, a byte order mark and blank lines are dropped, header rows (first cell ``category``) and rows of fewer than three
    cells are left out; ``global_id`` counts what is kept, from 0; then rows whose shot is no whole number go, which leaves gaps."""
    raw = spark.read.schema(schemas.PROMPTS_CSV).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    kept = raw.where(F.col("category").isNotNull() & F.col("raw_prompt").isNotNull() & (F.ltrim(F.col("category"), F.lit("﻿")) != "category"))
    shot = F.col("shot").try_cast("int")
    return numbered(kept, "global_id").where(shot.isNotNull()).select(F.col("global_id").cast("int"), "category", shot.alias("prompt_id"), "raw_prompt")


def json_lines(spark: SparkSession, path: str | list[str], schema: str, strict: bool = True) -> DataFrame:
    """Lines of JSON; blank lines are skipped, lines end at newlines only. strict: the first bad line that is read fails the job, which names its file; else it has nulls and ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _corrupt_record STRING").option("mode", "PERMISSIVE").json(path)


def tasks(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """All ``tasks_*.jsonl`` of a folder, files or folders of parts. The last line of a task by file name and place counts; strict: a missing or repeated id raises."""
    df = spark.read.schema(schemas.TASKS).option("mode", "FAILFAST").json(f"{folder}/tasks_*.jsonl")
    if strict:
        return unique(df, "task_id")
    placed = df.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()})
    return last_wins(placed.where("task_id IS NOT NULL"), ["task_id"], "_file", "_block", "_line").drop("_file", "_block", "_line")


def reports(spark: SparkSession, folder: str, skip: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All run reports as they are with their ``_file``, one JSON document per file, and the files that can't be read (``file, text``). skip: files whose names match (SQL LIKE) are left out."""
    text = spark.read.text(f"{folder}/*.json", wholetext=True).withColumn("_file", F.col("_metadata.file_name"))
    if skip:
        text = text.where(~F.col("_file").like(skip))
    parsed = text.withColumn("s", F.from_json("value", f"{schemas.STATE}, _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    good = parsed.where("s IS NOT NULL AND s._corrupt_record IS NULL").select("s.*", "_file").drop("_corrupt_record")
    bad = parsed.where("s IS NULL OR s._corrupt_record IS NOT NULL").select(F.col("_file").alias("file"), F.col("value").alias("text"))
    return good, bad


def report_key() -> Column:
    return F.coalesce(F.nullif(F.col("task_id"), F.lit("")), F.regexp_replace("_file", r"\.json$", ""))


def states(spark: SparkSession, folder: str, skip: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The run report of every task, and the files that can't be read.

    The key is ``task_id``, where missing or empty the file's stem; of several reports of a key the last file by name counts."""
    good, bad = reports(spark, folder, skip)
    return last_wins(good.withColumn("task_id", report_key()), ["task_id"], "_file").drop("_file"), bad


def key_set(spark: SparkSession, path: str | None, key: str = "task_id") -> DataFrame:
    """Distinct non-blank values of a key in JSON lines; no file is an empty set."""
    if path is None or not matches(spark, path):
        return spark.createDataFrame([], f"{key} STRING")
    return json_lines(spark, path, f"{key} STRING").where(f"{key} <> ''").select(key).distinct()


class ConflictingOverrides(ValueError):
    """Two different texts are to replace the prompt of one number."""


def prompt_overrides(spark: SparkSession, path: str | None) -> DataFrame:
    """``global_id, prompt``: replacement texts from a manifest, ``new_prompt`` or else the task's own; numbers or texts that are missing are skipped, different texts for one number raise."""
    if path is None or not matches(spark, path):
        return spark.createDataFrame([], "global_id INT, prompt STRING")
    df = override_rows(json_lines(spark, path, schemas.MANIFEST))
    clash = override_conflicts(df).orderBy("global_id").limit(10).collect()
    if clash:
        raise ConflictingOverrides(f"different prompts for {[r['global_id'] for r in clash]}")
    return df.groupBy("global_id").agg(F.max("prompt").alias("prompt"))


def override_rows(manifest: DataFrame) -> DataFrame:
    prompt = F.coalesce(F.nullif(F.col("new_prompt"), F.lit("")), F.col("task.raw_prompt"))
    return manifest.select(F.col("task.global_id").alias("global_id"), prompt.alias("prompt")).where("global_id IS NOT NULL AND prompt <> ''")


def override_conflicts(overrides: DataFrame) -> DataFrame:
    """Numbers with several different texts: ``global_id, texts``."""
    return overrides.groupBy("global_id").agg(F.count_distinct("prompt").alias("texts")).where("texts > 1")


def _first_column(df: DataFrame, *names: str):
    """The first of the named columns that the table has, even where it is empty."""
    held = [n for n in names if n in df.columns]
    return F.col(held[0]) if held else F.lit(None).cast("string")


def probe_records(df: DataFrame) -> DataFrame:
    """Measured values of a table of text columns, under their plain or ``actual_`` names, leniently read; the rate's text stays beside it."""
    from tessera.functions.scalars import frame_rate, lenient_float, lenient_int

    rate = _first_column(df, "actual_frame_rate", "frame_rate")
    return df.select(
        "task_id",
        lenient_int(_first_column(df, "actual_width", "width")).cast("int").alias("width"),
        lenient_int(_first_column(df, "actual_height", "height")).cast("int").alias("height"),
        frame_rate(rate).alias("frame_rate"),
        rate.alias("frame_rate_raw"),
        lenient_float(_first_column(df, "actual_duration_seconds", "duration_seconds")).alias("duration_seconds"),
        lenient_int(_first_column(df, "actual_num_frames", "num_frames")).cast("int").alias("num_frames"),
    )


def probe_cache(spark: SparkSession, path: str | None) -> DataFrame:
    """Measured values by task; no path is an empty table, a path without a file raises. Of several rows of a task the last counts."""
    if path is None:
        return probe_records(spark.createDataFrame([], schemas.PROBE))
    with_header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    placed = probe_records(with_header.where("task_id <> ''").withColumn("task_id", F.col("task_id"))).withColumn("_line", F.monotonically_increasing_id())
    return last_wins(placed, ["task_id"], "_line").drop("_line")


def prior_metadata(spark: SparkSession, path: str | None) -> DataFrame:
    """``task_id, file_size, sha256`` of an earlier release; the same rules."""
    if path is None:
        return spark.createDataFrame([], schemas.PRIOR)
    placed = json_lines(spark, path, schemas.PRIOR).where("task_id <> ''").withColumn("_line", F.monotonically_increasing_id())
    return last_wins(placed, ["task_id"], "_line").drop("_line")


def listing(spark: SparkSession, folders: list[str], ending: str) -> DataFrame:
    """``path, length`` of the files with an ending in flat folders, empty ones too (which Spark's own file sources pass over); a task per folder, contents are not read, a folder that isn't there is empty."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, at = (fs.LocalFileSystem(), folder.removeprefix("file:")) if "://" not in folder else fs.FileSystem.from_uri(folder)
                scheme = folder[: len(folder) - len(folder.partition("://")[2])] if "://" in folder else ""
                found = [f for f in system.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.type == fs.FileType.File and f.path.endswith(ending)]
                for k in range(0, len(found), 10_000):
                    part = found[k : k + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([scheme + f.path for f in part]), pa.array([f.size for f in part], pa.int64())], names=["path", "length"])

    ship(spark)
    return spark.createDataFrame([(f,) for f in folders], "folder string").repartition(max(1, len(folders))).mapInArrow(walk, "path string, length long")


def media_listing(spark: SparkSession, *folders: str, ending: str = ".mp4") -> DataFrame:
    """``task_id`` (the file's stem)``, path, length`` of flat folders."""
    from tessera.functions.scalars import file_stem

    return listing(spark, list(folders), ending).select(file_stem(F.col("path")).alias("task_id"), "path", "length")


def checksum_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, sha256`` of lines ``<digest>  <path>``; the last line of a path counts, lines without two blanks are left out."""
    return last_wins(manifest_lines(spark.read.text(path)).withColumn("_line", F.monotonically_increasing_id()), ["file_name"], "_line").drop("_line")


def manifest_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``file_name, sha256`` of rows that hold a line each. Line-end characters at a line's end belong to neither (a file may end its lines with CR LF); elsewhere in it they are data."""
    pattern = r"(?s)^(.*?)  (.*?)[\r\n]*\z"
    return lines.where(F.rlike(F.col(column), F.lit(pattern))).select(F.regexp_extract(column, pattern, 2).alias("file_name"), F.regexp_extract(column, pattern, 1).alias("sha256"))


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SHARD_INDEX).option("multiLine", True).json(path)


def csv_rows(spark: SparkSession, path: str) -> int:
    """Data rows of a CSV with a header; newlines within quotes don't count."""
    return spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).count()


def account_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``account, lines``: non-blank lines of ``tasks_<account>.jsonl`` (a file, or a folder of parts), counted without reading them as JSON."""
    text = spark.read.text(f"{folder}/tasks_*.jsonl").withColumn("account", F.regexp_extract(F.col("_metadata.file_path"), r"tasks_([^/]+?)\.jsonl(?:/[^/]*)?$", 1))
    return text.where(F.btrim("value") != "").groupBy("account").agg(F.count("*").alias("lines"))
