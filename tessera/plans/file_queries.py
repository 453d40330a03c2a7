"""Queries of the file sources and sinks: the test tables are written in the pipeline's formats to the shared folder and read again, each with SQL over the tables."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators import packing
from tessera.operators.keys import DuplicateKeys
from tessera.plans import checks, release
from tessera.plans.queries import _MEDIA, _META, _PAIRS, _PLAN, _STATES, _TASKS, CAPACITY, _media, _metadata, _state_keys, _states, _tasks
from tessera.session import cut, shared_folder, table
from tessera.sources import containers, files, sinks

QUERIES = {}
SQL = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


@query(f"WITH {_TASKS} SELECT task_id, account, global_id, raw_prompt, num_frames FROM t")
def task_files(spark, folder):
    """Task files by account, read with the last line of a task."""
    at = _folder(spark)
    sinks.tasks_by_account(_tasks(spark, folder).select(*schemas.columns(schemas.TASKS)), at)
    return files.tasks(spark, at).select("task_id", "account", "global_id", "raw_prompt", "num_frames")


@query("SELECT coalesce(account, 'null') AS account, count(*) AS lines FROM tasks GROUP BY 1")
def task_lines(spark, folder):
    at = _folder(spark)
    sinks.tasks_by_account(table(spark, folder, "tasks").select(*schemas.columns(schemas.TASKS)), at)
    return files.account_lines(spark, at)


@query("SELECT count(*) > count(DISTINCT task_id) AS refused FROM tasks")
def tasks_strict(spark, folder):
    at = _folder(spark)
    sinks.tasks_by_account(table(spark, folder, "tasks").select(*schemas.columns(schemas.TASKS)), at)
    try:
        files.tasks(spark, at, strict=True)
        refused = False
    except DuplicateKeys:
        refused = True
    return spark.createDataFrame([(refused,)], "refused boolean")


def _write_each(df: DataFrame, at: str, name: str, content: Callable[[dict], bytes]) -> int:
    """A file for every row; the number of files."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = containers.storage(at)
        system.create_dir(root, recursive=True)
        for b in batches:
            for row in b.to_pylist():
                with system.open_output_stream(f"{root}/{row[name]}") as f:
                    f.write(content(row))
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    return cut(df.mapInArrow(write, "n long")).agg(F.sum("n")).first()[0] or 0


@query("""SELECT count(*) AS reports, count(DISTINCT coalesce(nullif(task_id, ''), file_stem)) AS tasks, count(*) FILTER (status = 'done') AS done, 1::BIGINT AS unreadable FROM state""")
def report_files(spark, folder):
    """One JSON document per report, and one that is cut off."""
    at = _folder(spark)
    state = _state_keys(spark, folder).select(*[c for c in schemas.columns(schemas.STATE) if c in ("task_id", "status", "video_id", "output_path", "retries")])
    named = cut(state.withColumn("body", F.to_json(F.struct("*"))).withColumn("name", F.concat(F.monotonically_increasing_id().cast("string"), F.lit(".json"))).select("name", "body"))
    broken = spark.createDataFrame([("zz.json", '{"task_id": ')], "name string, body string")
    _write_each(named.unionByName(broken), at, "name", lambda r: r["body"].encode())
    every, bad = files.reports(spark, at)
    kept = files.states(spark, at)[0]
    one = lambda df, *aggs: df.agg(*aggs).withColumn("_k", F.lit(1))
    counted = one(every, F.count("*").alias("reports"), F.count_if(F.col("status") == "done").alias("done")).join(one(kept, F.count("*").alias("tasks")), "_k")
    return counted.join(one(bad, F.count("*").alias("unreadable")), "_k").select("reports", "tasks", "done", "unreadable")


@query("SELECT category, prompt_id, raw_prompt FROM tasks WHERE category <> '' AND raw_prompt <> '' AND prompt_id IS NOT NULL")
def prompt_file(spark, folder):
    """The prompt CSV: header rows, rows without three cells and shots that are no number are left out."""
    at = _folder(spark)
    tasks = table(spark, folder, "tasks").select("category", F.coalesce(F.col("prompt_id").cast("string"), F.lit("x")).alias("prompt_id"), "raw_prompt")
    sinks.csv_table(tasks, at)
    return files.prompts_csv(spark, at).select("category", "prompt_id", "raw_prompt")


@query("WITH m AS (SELECT count(*) AS rows FROM metadata) SELECT rows AS csv_rows, rows AS json_rows, rows AS parquet_rows, (SELECT count(DISTINCT task_id) FROM metadata) AS tasks FROM m")
def release_files(spark, folder):
    at, md = _folder(spark), table(spark, folder, "metadata")
    sinks.csv_table(md, f"{at}/metadata.csv", schemas.columns(schemas.METADATA), ["task_id"])
    sinks.json_table(md, f"{at}/metadata.jsonl", ["task_id"])
    sinks.parquet_table(md, f"{at}/metadata.parquet")
    rows = files.json_lines(spark, f"{at}/metadata.jsonl", schemas.METADATA).agg(F.count("*").alias("json_rows"), F.count_distinct("task_id").alias("tasks")).first()
    made = (files.csv_rows(spark, f"{at}/metadata.csv"), rows["json_rows"], spark.read.parquet(f"{at}/metadata.parquet").count(), rows["tasks"])
    return spark.createDataFrame([made], "csv_rows long, json_rows long, parquet_rows long, tasks long")


@query(f"WITH {_META} SELECT task_id, prompt_zh, coalesce(shard, '') AS shard, coalesce(file_size::VARCHAR, '') AS file_size FROM md")
def release_csv(spark, folder):
    """Blanks for nulls, quotes and line ends within values kept."""
    at = _folder(spark)
    sinks.csv_table(_metadata(spark, folder, "prompt_zh", "shard", "file_size"), at, ["task_id", "prompt_zh", "shard", "file_size"], ["task_id"])
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(at)
    return read.select("task_id", "prompt_zh", *[F.coalesce(c, F.lit("")).alias(c) for c in ("shard", "file_size")])


@query(f"WITH {_META} SELECT task_id, file_size, sha256 FROM md WHERE task_id <> ''")
def prior_release(spark, folder):
    at = _folder(spark)
    sinks.json_table(_metadata(spark, folder, "file_size", "sha256"), at, ["task_id"])
    return files.prior_metadata(spark, at)


_DIGEST = "^[0-9a-fA-F]{64}$"


@query(f"WITH {_META} SELECT 'videos/' || task_id || '.mp4' AS file_name, sha256 FROM md WHERE regexp_matches(sha256, '{_DIGEST}')")
def manifest_file(spark, folder):
    at = _folder(spark)
    md = _metadata(spark, folder, "sha256").select(F.concat(F.lit("videos/"), "task_id", F.lit(".mp4")).alias("file_name"), F.when(F.rlike("sha256", F.lit(_DIGEST)), F.col("sha256")).alias("sha256"))
    sinks.checksum_lines(md, at)
    return files.checksum_manifest(spark, at)


@query(f"WITH {_META} SELECT task_id, actual_width AS width, actual_height AS height, CASE WHEN num_frames IS NOT NULL THEN round(num_frames / 1001.0, 6) END AS frame_rate, actual_duration_seconds AS duration_seconds, actual_num_frames AS num_frames FROM md WHERE task_id <> ''")
def probe_file(spark, folder):
    """The probe cache: rates as fractions, blanks as nulls."""
    at = _folder(spark)
    md = _metadata(spark, folder, "num_frames", "actual_width", "actual_height", "actual_duration_seconds", "actual_num_frames")
    rate = F.concat(F.col("num_frames").cast("string"), F.lit("/1001"))
    sinks.csv_table(md.select("task_id", F.col("actual_width").alias("width"), F.col("actual_height").alias("height"), rate.alias("frame_rate"), F.col("actual_duration_seconds").alias("duration_seconds"), F.col("actual_num_frames").alias("num_frames")), at)
    return files.probe_cache(spark, at).drop("frame_rate_raw")


@query("SELECT DISTINCT task_id FROM state WHERE status = 'failed' AND task_id <> ''")
def newest_key_set(spark, folder):
    """Of two backups the last by name."""
    at, state = _folder(spark), table(spark, folder, "state").select("task_id", "status")
    sinks.json_table(state.where("status = 'done'").select("task_id"), f"{at}/backup_a.jsonl")
    sinks.json_table(state.where("status = 'failed'").select("task_id"), f"{at}/backup_b.jsonl")
    return files.key_set(spark, files.newest(spark, f"{at}/backup_*.jsonl"))


@query("SELECT global_id, max(raw_prompt) AS prompt FROM tasks WHERE withdrawn_at IS NOT NULL AND global_id IS NOT NULL AND raw_prompt <> '' GROUP BY 1")
def override_file(spark, folder):
    at = _folder(spark)
    one = table(spark, folder, "tasks").where("withdrawn_at IS NOT NULL AND raw_prompt <> ''").groupBy("global_id").agg(F.max("raw_prompt").alias("raw_prompt"))
    sinks.json_table(one.select(F.lit("").alias("new_prompt"), F.struct("global_id", "raw_prompt").alias("task")), at)
    return files.prompt_overrides(spark, at)


def _video(row: dict) -> bytes:
    """Boxes in one of five layouts: in order, ``moov`` beyond the head, a 64-bit size, an open end, no ``moov``."""
    box = lambda kind, body: struct.pack(">I", 8 + len(body)) + kind + body
    start, moov, mdat = box(b"ftyp", b"isom"), box(b"moov", b"m" * 9), b"x" * (row["n"] + 1)
    return start + (moov + box(b"mdat", mdat), box(b"mdat", b"x" * 5000) + moov, struct.pack(">I", 1) + b"mdat" + struct.pack(">Q", 16 + len(mdat)) + mdat + moov, moov + struct.pack(">I", 0) + b"mdat" + mdat, box(b"free", mdat))[row["n"] % 5]


def _videos(spark: SparkSession, folder: str) -> str:
    at = _folder(spark)
    ids = table(spark, folder, "media").where("task_id <> ''").select("task_id").distinct()
    _write_each(ids.withColumn("n", F.length("task_id") + F.ascii("task_id")).withColumn("name", F.concat("task_id", F.lit(".mp4"))), at, "name", _video)
    return at


_IDS = "i AS (SELECT DISTINCT task_id, length(task_id) + ascii(task_id) AS n FROM media WHERE task_id <> '')"


@query(f"""WITH {_IDS} SELECT task_id, (12 + CASE n % 5 WHEN 0 THEN 17 + 8 + n + 1 WHEN 1 THEN 5008 + 17 WHEN 2 THEN 16 + n + 1 + 17 WHEN 3 THEN 17 + 8 + n + 1 ELSE 8 + n + 1 END)::BIGINT AS length,
CASE n % 5 WHEN 0 THEN 'ftyp,moov,mdat' WHEN 1 THEN 'ftyp,mdat,moov' WHEN 2 THEN 'ftyp,mdat,moov' WHEN 3 THEN 'ftyp,moov,mdat' ELSE 'ftyp,free' END AS kinds,
CASE n % 5 WHEN 0 THEN 'ftyp,moov,mdat' WHEN 1 THEN 'ftyp,mdat,moov' WHEN 2 THEN 'ftyp,mdat,moov' WHEN 3 THEN 'ftyp,moov,mdat' ELSE 'ftyp,free' END AS head_kinds,
CASE WHEN n % 5 IN (1, 2) THEN -1 ELSE 9 END AS moov_place FROM i""")
def video_boxes(spark, folder):
    """Box headers of real layouts, by seeking through the file and within its head (where the walk ends at a 64-bit size, and ``moov`` may only be found by name)."""
    listed = files.media_listing(spark, _videos(spark, folder))
    moov = F.coalesce(F.get(F.filter("boxes", lambda b: b["btype"] == "moov"), F.lit(0))["offset"], F.lit(9))
    seek = containers.with_boxes(listed, "path").select("task_id", "length", F.array_join("boxes.btype", ",").alias("kinds"))
    head = containers.with_boxes(listed, "path", "head").select("task_id", F.array_join("boxes.btype", ",").alias("head_kinds"), F.when(moov == -1, -1).otherwise(9).alias("moov_place"))
    return seek.join(head, "task_id")


@query(f"WITH {_IDS} SELECT task_id, n % 5 <> 4 AS ok, CASE WHEN n % 5 = 4 THEN 'no moov' ELSE '' END AS issues FROM i")
def video_integrity(spark, folder):
    floors = spark.createDataFrame([("none", 1)], "resolution string, min_bytes long")
    sound = containers.integrity(containers.with_boxes(files.media_listing(spark, _videos(spark, folder))), floors, 1)
    return sound.select("task_id", "ok", F.array_join("issues", ",").alias("issues"))


@query("SELECT DISTINCT task_id, sha256(task_id) AS sha256 FROM media WHERE task_id <> ''")
def file_digests(spark, folder):
    at = _folder(spark)
    ids = table(spark, folder, "media").where("task_id <> ''").select("task_id").distinct()
    _write_each(ids.withColumn("name", F.concat("task_id", F.lit(".mp4"))), at, "name", lambda r: r["task_id"].encode())
    return containers.digests(files.media_listing(spark, at)).select("task_id", "sha256")


@query("SELECT 'videos/' || task_id || '.mp4' AS member, length(task_id)::BIGINT AS size, true AS indexed FROM (SELECT DISTINCT task_id FROM media WHERE task_id <> '')")
def tar_round_trip(spark, folder):
    """Files packed into tar shards, the shard index and the members read again."""
    at, out = _folder(spark), _folder(spark)
    ids = table(spark, folder, "media").where("task_id <> ''").select("task_id").distinct()
    _write_each(ids.withColumn("name", F.concat("task_id", F.lit(".mp4"))), at, "name", lambda r: r["task_id"].encode())
    packed = cut(packing.next_fit(files.media_listing(spark, at).select("task_id", "path", "length"), ["task_id"], "length", 1000))
    sinks.prepare(spark, out)
    sinks.shard_index(spark, sinks.tar_shards(packed, out), f"{out}/shard_index.json")
    index = files.shard_index(spark, f"{out}/shard_index.json").select("shard", "num_videos")
    members = containers.tar_members(spark, files.matches(spark, f"{out}/shards/*.tar")).withColumn("shard", F.regexp_extract("archive", r"(shards/[^/]+)$", 1))
    held = members.groupBy("shard").agg(F.count("*").alias("n")).join(index, "shard", "left")
    return members.join(held, "shard").select("member", "size", F.col("n").eqNullSafe(F.col("num_videos")).alias("indexed"))


@query(f"""WITH {_TASKS}, {_STATES}, {_MEDIA} SELECT task_id, 'no file' AS problem FROM t WHERE task_id NOT IN (SELECT task_id FROM m)
UNION ALL SELECT t.task_id, 'status ' || coalesce(s.status, '?') FROM t LEFT JOIN s ON s.task_id = t.task_id WHERE s.status IS DISTINCT FROM 'done'""")
def incomplete_tasks(spark, folder):
    return release.incomplete(_tasks(spark, folder).select("task_id"), _states(spark, folder, "status"), _media(spark, folder))


_BLANK = lambda *cs: " || ".join(f"CASE WHEN coalesce({c}, '') = '' THEN ',{c}' ELSE '' END" for c in cs)


@query(f"""WITH g AS (SELECT global_id, count(*) AS n FROM metadata WHERE global_id IS NOT NULL GROUP BY 1), k AS (SELECT coalesce(a.shot_id, b.d) AS key, a.n, b.d IS NOT NULL AS known FROM (SELECT shot_id, count(*) AS n FROM metadata GROUP BY 1) a FULL JOIN (SELECT unnest(range(1, 11))::INT AS d) b ON a.shot_id = b.d),
p AS (SELECT coalesce(a.resolution, b.resolution) AS key, a.n, b.resolution IS NOT NULL AS known FROM (SELECT resolution, count(*) AS n FROM metadata GROUP BY 1) a FULL JOIN profiles b ON a.resolution = b.resolution),
v(rule_id, subject, detail) AS (SELECT 'unique_task', task_id, 'rows: ' || count(*) FROM metadata GROUP BY task_id HAVING count(*) > 1
UNION ALL SELECT 'prompt_groups', global_id::VARCHAR, 'rows: ' || n || ', expected 3' FROM g WHERE n <> 3
UNION ALL SELECT 'prompt_groups', 'groups', count(*) || ', expected 7' FROM g HAVING count(*) <> 7
UNION ALL SELECT 'shots', coalesce(key::VARCHAR, 'null'), CASE WHEN known THEN 'rows: ' || coalesce(n, 0) ELSE 'not in the domain' END FROM k WHERE NOT known OR coalesce(n, 0) <> 300
UNION ALL SELECT 'profiles', coalesce(key, 'null'), CASE WHEN known THEN 'rows: ' || coalesce(n, 0) ELSE 'not in the domain' END FROM p WHERE NOT known OR coalesce(n, 0) <> 1000
UNION ALL SELECT 'measured_values', task_id, detail FROM (SELECT md.task_id, CASE WHEN p.resolution IS NULL THEN 'unknown resolution' ELSE ltrim({_PAIRS}, ',') END AS detail FROM metadata md LEFT JOIN profiles p USING (resolution)) WHERE detail <> ''
UNION ALL SELECT 'media_source', task_id, 'media_metadata_source: ' || coalesce(media_metadata_source, 'null') FROM metadata WHERE media_metadata_source IS DISTINCT FROM 'ffprobe_cache'
UNION ALL SELECT 'located', task_id, 'blank ' || ltrim({_BLANK('file_name', 'shard')}, ',') FROM metadata WHERE coalesce(file_name, '') = '' OR coalesce(shard, '') = ''
UNION ALL SELECT 'digest', task_id, 'blank sha256' FROM metadata WHERE coalesce(sha256, '') = ''
UNION ALL SELECT 'metadata_rows', 'rows', count(*) || ', expected 5' FROM metadata HAVING count(*) <> 5
UNION ALL SELECT 'prompt_rows', 'rows', count(DISTINCT global_id) || ', expected 7' FROM metadata HAVING count(DISTINCT global_id) <> 7
UNION ALL SELECT 'csv_rows', 'rows', count(*) || ', in the CSV 11' FROM metadata HAVING count(*) <> 11)
SELECT rule_id, 'error' AS severity, subject, detail FROM v""")
def release_rules(spark, folder):
    """All rules of a release's tables, against a shape that the test table has not."""
    md = table(spark, folder, "metadata")
    prompts = md.where("global_id IS NOT NULL").select("global_id").distinct()
    shape = checks.Shape(5, 7, 3, tuple(range(1, 11)), 300, 1000)
    return checks.release_violations(md, prompts, table(spark, folder, "profiles"), shape, 11)


@query("""WITH x AS (SELECT task_id, global_id % 7 AS s, 'videos/' || task_id AS file_name, upper(coalesce(sha256, '')) AS sha256 FROM (SELECT task_id, max(global_id) AS global_id, max(sha256) AS sha256 FROM metadata WHERE global_id IS NOT NULL GROUP BY 1)),
c AS (SELECT file_name, CASE WHEN s = 6 THEN 'other' ELSE sha256 END AS sha256 FROM x WHERE s <> 2),
v(rule_id, subject, detail) AS (SELECT DISTINCT 'shard_set', 's' || s, 'only in metadata' FROM x WHERE s = 3 UNION ALL SELECT 'shard_set', 's9', 'only in index'
UNION ALL SELECT DISTINCT 'shard_file', 's' || s, 'no file' FROM x WHERE s = 4 UNION ALL SELECT 'shard_file', 's9', 'no file' UNION ALL SELECT DISTINCT 'shard_size', 's' || s, '11 / 10' FROM x WHERE s = 5
UNION ALL SELECT 'shard_members', 's' || s || ' ' || file_name, 'only in metadata' FROM x WHERE s = 1
UNION ALL SELECT 'shard_members', 's0 odd', 'only in archive'
UNION ALL SELECT 'checksums', coalesce(x.file_name, c.file_name), coalesce(x.sha256, 'null') || ' / ' || coalesce(c.sha256, 'null') FROM x FULL JOIN c ON x.file_name = c.file_name WHERE x.sha256 IS DISTINCT FROM c.sha256)
SELECT rule_id, 'error' AS severity, subject, detail FROM v""")
def shard_rules(spark, folder):
    """The rules of shards: seven made of the prompt numbers, each with a fault of its own, and one that only the index names."""
    md = table(spark, folder, "metadata").where("global_id IS NOT NULL").groupBy("task_id").agg(F.max("global_id").alias("g"), F.max("sha256").alias("sha256"))
    s = F.col("g") % 7
    x = cut(md.select("task_id", F.concat(F.lit("s"), s).alias("shard"), F.concat(F.lit("videos/"), "task_id").alias("file_name"), F.upper(F.coalesce("sha256", F.lit(""))).alias("sha256")))
    shards = x.select("shard").distinct()
    index = shards.where("shard <> 's3'").unionByName(spark.createDataFrame([("s9",)], "shard string")).withColumn("size_bytes", F.lit(10).cast("bigint"))
    archives = shards.where("shard <> 's4'").withColumn("length", F.when(F.col("shard") == "s5", 11).otherwise(10).cast("bigint"))
    members = x.where("shard NOT IN ('s1', 's4')").select("shard", "file_name").unionByName(spark.createDataFrame([("s0", "odd")], "shard string, file_name string"))
    sums = x.where("shard <> 's2'").select("file_name", F.when(F.col("shard") == "s6", "other").otherwise(F.col("sha256")).alias("sha256"))
    return checks.shard_violations(x, index, archives, members, sums)


@query(f"""WITH {_TASKS}, {_STATES}, {_MEDIA}, n AS (SELECT (SELECT count(*) FROM t) AS tasks, (SELECT count(*) FROM s) AS states, (SELECT count(*) FROM m) AS mp4, (SELECT count(*) FROM m SEMI JOIN t USING (task_id)) AS task_mp4, (SELECT sum(length)::BIGINT FROM m SEMI JOIN t USING (task_id)) AS video_size_bytes)
SELECT n.*, false AS ok FROM n""")
def project_report_file(spark, folder):
    """The report of a project as a JSON document."""
    at = _folder(spark)
    made, reports, media = cut(_tasks(spark, folder).select("task_id", "account", "resolution")), cut(_states(spark, folder, "status")), cut(_media(spark, folder))
    found = cut(checks.project_violations(made, reports, media))
    sinks.report(spark, f"{at}/validation_report.json", checks.project_report(made, reports, media, found))
    names = ("tasks", "states", "mp4", "task_mp4", "video_size_bytes")
    read = spark.read.schema(f"counts struct<{', '.join(f'{n}: bigint' for n in names)}>, ok boolean").option("multiLine", True).json(f"{at}/validation_report.json")
    return read.select("counts.*", "ok")


@query(f"WITH {_PLAN} SELECT w.task_id, 'videos/' || w.task_id || '.mp4' AS file_name, printf('shards/train-%05d.tar', shard_no) AS shard, prompt_zh FROM w JOIN md USING (task_id)")
def located_release(spark, folder):
    """File name and shard of every row as they are after packing."""
    source = _metadata(spark, folder, "file_name", "shard", "prompt_zh", "file_size")
    packed = cut(packing.next_fit(source.select("task_id", "file_size"), ["task_id"], "file_size", CAPACITY))
    return sinks.located(source, packed).select("task_id", "file_name", "shard", "prompt_zh")


@query(f"WITH {_MEDIA}, {_META} SELECT count(*) AS files, count(*) FILTER (md.file_size = m.length AND length(md.sha256) = 64) AS reused FROM m LEFT JOIN md USING (task_id)")
def reused_digest_count(spark, folder):
    return release.reused_digests(_media(spark, folder), _metadata(spark, folder, "file_size", "sha256"), None).agg(F.count("*").alias("files"), F.count_if("reused").alias("reused"))


@query(f"WITH {_IDS} SELECT count(*) AS files, count(*) FILTER (n % 5 <> 4) AS passed FROM i")
def integrity_counts(spark, folder):
    return video_integrity(spark, folder).agg(F.count("*").alias("files"), F.count_if("ok").alias("passed"))


def _said(path: str) -> dict:
    """In place of the external program: the file's size as its frames, a fraction as its rate."""
    with containers.opened(path) as f:
        return {"num_frames": f.size(), "frame_rate": f"{f.size()}/7"} if f.size() % 2 else {}


@query("SELECT DISTINCT task_id, length(task_id)::INT AS num_frames, round(length(task_id) / 7.0, 6) AS frame_rate FROM media WHERE task_id <> '' AND length(task_id) % 2 = 1")
def probed_files(spark, folder):
    """Every file given to a probe; those it says nothing of are left out."""
    at = _folder(spark)
    ids = table(spark, folder, "media").where("task_id <> ''").select("task_id").distinct()
    _write_each(ids.withColumn("name", F.concat("task_id", F.lit(".mp4"))), at, "name", lambda r: r["task_id"].encode())
    return files.probe_records(containers.probed(files.media_listing(spark, at), _said)).select("task_id", "num_frames", "frame_rate")


@query("SELECT count(*) AS rows, count(*) FILTER (coalesce(error, '') = '') AS without_error, sum(coalesce(retries, 0))::BIGINT AS retries FROM state")
def stats_file(spark, folder):
    """The statistics of all reports as CSV."""
    at = _folder(spark)
    sinks.csv_table(table(spark, folder, "state"), at, schemas.columns(schemas.STATS), ["task_id"])
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(at)
    return read.agg(F.count("*").alias("rows"), F.count_if(F.coalesce("error", F.lit("")) == "").alias("without_error"), F.sum(F.coalesce(F.col("retries").try_cast("bigint"), F.lit(0))).alias("retries"))
