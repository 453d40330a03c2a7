"""Queries of the pipeline's operators over the project's tables, each with SQL of the same result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions import scalars, text
from tessera.operators import keys, packing, profiling, reconcile, rules
from tessera.plans import checks, release, tasks as task_plan
from tessera.session import cut, table
from tessera.sources import containers, files

# Our own neutral removal list and template; a release brings its own.
TOKENS = ("documentary look", "no retouching", "unposed", "lens breathing visible", "8K", "24mm", "f/", "手机", "ambient sound feel")
PREFIX, SUFFIX, NEGATIVE = "A clip: ", " End.", "no text, no marks"
CAPACITY = 150_000_000

QUERIES = {}
SQL = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _tasks(spark: SparkSession, folder: str) -> DataFrame:
    """The current row of every task."""
    return keys.last_wins(table(spark, folder, "tasks").drop("source_file"), ["task_id"], "loaded_at", "withdrawn_at", "raw_prompt")


_TASKS = "t AS (SELECT * FROM tasks QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY loaded_at DESC NULLS LAST, withdrawn_at DESC NULLS LAST, raw_prompt DESC NULLS LAST) = 1)"


def _state_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "state").select("loaded_at", "status", "output_path", "started_at", "completed_at", "retries", "video_id", "repaired_at", F.coalesce(F.nullif(F.col("task_id"), F.lit("")), F.col("file_stem")).alias("task_id"))


def _states(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    """The last report of every task, keyed by its id or else the file's stem; keep: the columns wanted."""
    order = ("loaded_at", "status", "output_path", "started_at", "completed_at", "retries")
    return keys.last_wins(_state_keys(spark, folder), ["task_id"], *order, keep=keep)


_STATES = """s AS (SELECT * REPLACE (coalesce(nullif(task_id, ''), file_stem) AS task_id) FROM state
  QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(task_id, ''), file_stem) ORDER BY loaded_at DESC NULLS LAST, status DESC NULLS LAST, output_path DESC NULLS LAST, started_at DESC NULLS LAST, completed_at DESC NULLS LAST, retries DESC NULLS LAST) = 1)"""


def _media(spark: SparkSession, folder: str) -> DataFrame:
    """The files that are there, one row per task."""
    return table(spark, folder, "media").where("removed_at IS NULL AND task_id IS NOT NULL").groupBy("task_id").agg(F.max("path").alias("path"), F.max("length").alias("length"))


_MEDIA = "m AS (SELECT task_id, max(path) AS path, max(length) AS length FROM media WHERE removed_at IS NULL AND task_id IS NOT NULL GROUP BY 1)"


def _metadata(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return keys.last_wins(table(spark, folder, "metadata"), ["task_id"], "file_size", "sha256", keep=keep)


_META = "md AS (SELECT * FROM metadata QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY file_size DESC NULLS LAST, sha256 DESC NULLS LAST) = 1)"

_DIRTY = "concat(coalesce(raw_prompt, ''), ' ,, , unposed,  8unposedK，')"
_CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace({}, ',{{2,}}', ',', 'g'), ',(?: ,)+', ',', 'g'), ' {{2,}}', ' ', 'g'), ' ,，.')"


def _clean_sql(column: str) -> str:
    return _CLEAN.format(reduce(lambda c, t: f"replace({c}, '{t}', '')", TOKENS, column))


@query(f"SELECT task_id, {_clean_sql(_DIRTY)} AS cleaned FROM tasks")
def clean_text(spark, folder):
    return table(spark, folder, "tasks").select("task_id", text.clean(F.expr(_DIRTY), TOKENS).alias("cleaned"))


@query(f"SELECT task_id, '{PREFIX}' || {_clean_sql('raw_prompt')} || '{SUFFIX}' AS enhanced, '{NEGATIVE}' AS negative FROM tasks")
def enhance_text(spark, folder):
    e = text.enhance(F.col("raw_prompt"), TOKENS, PREFIX, SUFFIX, NEGATIVE)
    return table(spark, folder, "tasks").select("task_id", e.alias("e")).select("task_id", "e.enhanced", "e.negative")


@query(f"SELECT doc_id, md5({reduce(lambda c, t: f'replace({c}, {chr(39)}{t}{chr(39)}, {chr(39)}{chr(39)})', ('the ', ' der', 'le ', '所述'), 'text')}) AS digest FROM documents")
def remove_tokens_bulk(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.md5(text.remove_tokens_bulk(["the ", " der", "le ", "所述"])(F.col("text"))).alias("digest"))


def _prompts(spark, folder):
    return keys.last_wins(table(spark, folder, "tasks").where("global_id IS NOT NULL").select("global_id", "prompt_id", "category", "raw_prompt"), ["global_id"], "prompt_id", "category", "raw_prompt")


_PROMPTS = """p AS (SELECT global_id, prompt_id, category, raw_prompt FROM tasks WHERE global_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY global_id ORDER BY prompt_id DESC NULLS LAST, category DESC NULLS LAST, raw_prompt DESC NULLS LAST) = 1)"""
_FAN = f"""{_PROMPTS}, f AS (SELECT printf('%s_g%04d_%s', substr('ABCDEFGHIJ', global_id % 10 + 1, 1), global_id, resolution) AS task_id, substr('ABCDEFGHIJ', global_id % 10 + 1, 1) AS account,
  global_id, prompt_id, category, raw_prompt, resolution, width, height, num_frames, frame_rate FROM p CROSS JOIN profiles)"""


@query(f"WITH {_FAN} SELECT * FROM f")
def task_fanout(spark, folder):
    return task_plan.task_table(_prompts(spark, folder), table(spark, folder, "profiles"))


@query(f"""WITH {_FAN} SELECT account, count(*) FILTER (resolution = '1080p') AS n_1080p, count(*) FILTER (resolution = '720p') AS n_720p, count(*) FILTER (resolution = '480p') AS n_480p,
count(*) AS tasks, sum(num_frames)::BIGINT AS frames FROM f GROUP BY 1""")
def tasks_by_account_profile(spark, folder):
    return task_plan.load_by_account(task_fanout(spark, folder), ["1080p", "720p", "480p"])


@query("SELECT global_id, (row_number() OVER (ORDER BY global_id) - 1)::BIGINT AS ordinal FROM (SELECT DISTINCT global_id FROM tasks WHERE global_id IS NOT NULL)")
def numbered_prompts(spark, folder):
    ids = cut(table(spark, folder, "tasks").where("global_id IS NOT NULL").select("global_id").distinct().orderBy("global_id"))
    return keys.numbered(ids, "ordinal")


@query("SELECT file_stem, try_cast(started_at AS BIGINT) AS started_epoch FROM state WHERE try_cast(started_at AS BIGINT) IS NOT NULL")
def int_filter(spark, folder):
    n = scalars.lenient_int(F.col("started_at"))
    return table(spark, folder, "state").where(n.isNotNull()).select("file_stem", n.alias("started_epoch"))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, folder):
    return keys.last_wins(table(spark, folder, "events"), ["user_id"], "ts", "event_id", keep=["event_id", "event_type", "value"])


@query(f"WITH {_STATES} SELECT task_id, status, video_id, retries FROM s")
def last_reports(spark, folder):
    return _states(spark, folder, "status", "video_id", "retries")


_STAGES = """g AS (SELECT task_id, CASE WHEN task_id IN (SELECT task_id FROM tasks WHERE withdrawn_at IS NOT NULL) THEN 'policy16_prompt_rewrite' ELSE 'rerun_99' END AS stage
  FROM (SELECT task_id FROM tasks WHERE withdrawn_at IS NOT NULL UNION SELECT task_id FROM s WHERE retries > 1))"""


def _stages(spark, folder):
    return release.repair_stages(table(spark, folder, "tasks").where("withdrawn_at IS NOT NULL").select("task_id"), _states(spark, folder, "retries").where("retries > 1").select("task_id"))


@query(f"""WITH {_TASKS}, {_STATES}, {_STAGES}
SELECT t.task_id, coalesce(stage, CASE WHEN coalesce(repaired_at, '') <> '' THEN 'state_repair' END, 'initial') AS repair_stage FROM t LEFT JOIN s USING (task_id) LEFT JOIN g USING (task_id)""")
def overlay_precedence(spark, folder):
    df = table(spark, folder, "tasks").select("task_id").distinct().join(_states(spark, folder, "repaired_at"), "task_id", "left").join(_stages(spark, folder), "task_id", "left")
    return df.select("task_id", release.stage_of(F.col("stage"), F.col("repaired_at")).alias("repair_stage"))


def _cache(spark, folder):
    """Measured values of files that were probed, as a probe cache has them."""
    probed = _metadata(spark, folder, "actual_width", "actual_height", "actual_frame_rate", "actual_duration_seconds", "actual_num_frames", "media_metadata_source").where("media_metadata_source = 'ffprobe_cache'")
    return probed.select("task_id", F.col("actual_width").alias("width"), F.col("actual_height").alias("height"), F.col("actual_frame_rate").alias("frame_rate"), F.col("actual_duration_seconds").alias("duration_seconds"), F.col("actual_num_frames").alias("num_frames"))


_CACHE = "c AS (SELECT task_id, actual_width, actual_height, actual_frame_rate, actual_duration_seconds, actual_num_frames FROM md WHERE media_metadata_source = 'ffprobe_cache')"
_VALUES = f"""v AS (SELECT t.task_id, CASE WHEN c.task_id IS NOT NULL THEN c.actual_width ELSE p.encoded_w END AS actual_width, CASE WHEN c.task_id IS NOT NULL THEN c.actual_height ELSE p.encoded_h END AS actual_height,
  CASE WHEN c.task_id IS NOT NULL THEN c.actual_frame_rate ELSE t.frame_rate::DOUBLE END AS actual_frame_rate,
  CASE WHEN c.task_id IS NOT NULL THEN c.actual_duration_seconds ELSE round(t.num_frames / nullif(t.frame_rate, 0), 6) END AS actual_duration_seconds,
  CASE WHEN c.task_id IS NOT NULL THEN c.actual_num_frames ELSE t.num_frames END AS actual_num_frames,
  CASE WHEN c.task_id IS NOT NULL THEN 'ffprobe_cache' ELSE 'observed_resolution_profile' END AS media_metadata_source
  FROM t LEFT JOIN c USING (task_id) LEFT JOIN profiles p ON p.resolution = t.resolution)"""


@query(f"WITH {_TASKS}, {_META}, {_CACHE}, {_VALUES} SELECT * FROM v")
def probe_precedence(spark, folder):
    v = release.measured(_tasks(spark, folder), _cache(spark, folder), None, table(spark, folder, "profiles"))
    return v.select("task_id", *[F.col(f"m.{a}").alias(b) for a, b in (("width", "actual_width"), ("height", "actual_height"), ("frame_rate", "actual_frame_rate"), ("duration_seconds", "actual_duration_seconds"), ("num_frames", "actual_num_frames"))], "media_metadata_source")


@query(f"""WITH {_TASKS}, {_STATES}, {_MEDIA}, {_META}, {_CACHE}, {_VALUES}, {_STAGES}, f AS (SELECT m.task_id, m.length, md.sha256 FROM m LEFT JOIN md ON md.task_id = m.task_id AND md.file_size = m.length AND length(md.sha256) = 64)
SELECT t.task_id, coalesce(nullif(t.account, ''), split_part(t.task_id, '_', 1)) AS account, t.global_id, t.global_id AS prompt_id, t.prompt_id AS shot_id, category, t.resolution, raw_prompt AS prompt_zh,
 '{PREFIX}' || {_clean_sql('raw_prompt')} || '{SUFFIX}' AS enhanced_prompt, '{NEGATIVE}' AS negative_prompt, width AS requested_width, height AS requested_height, actual_width, actual_height, t.num_frames, t.frame_rate,
 round(t.num_frames / nullif(t.frame_rate, 0), 6) AS duration_seconds, actual_frame_rate, actual_duration_seconds, actual_num_frames, media_metadata_source, 'model' AS source_model, 'api' AS generation_api,
 video_id, status, started_at, completed_at, coalesce(retries, 0) AS retries, coalesce(stage, CASE WHEN coalesce(repaired_at, '') <> '' THEN 'state_repair' END, 'initial') AS repair_stage,
 'output/' || t.task_id || '.mp4' AS file_name, NULL::VARCHAR AS shard, f.length AS file_size, f.sha256
FROM t LEFT JOIN s USING (task_id) LEFT JOIN f USING (task_id) LEFT JOIN v USING (task_id) LEFT JOIN g USING (task_id)""")
def metadata_projection(spark, folder):
    made = _tasks(spark, folder)
    held = release.reused_digests(_media(spark, folder), _metadata(spark, folder, "file_size", "sha256"), None)
    config = release.Config("model", "api", lambda c: text.enhance(c, TOKENS, PREFIX, SUFFIX, NEGATIVE))
    values = release.measured(made, _cache(spark, folder), None, table(spark, folder, "profiles"))
    return release.metadata(made, _states(spark, folder, "status", "video_id", "started_at", "completed_at", "repaired_at", "retries"), held, values, _stages(spark, folder), config)


@query("""WITH x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN concat(o_orderkey % 97, '/', o_orderkey % 7) WHEN 1 THEN concat(o_orderkey, '000/1001') WHEN 2 THEN concat(o_orderkey % 61, '.5') WHEN 3 THEN 'N/A' ELSE '' END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN contains(raw, '/') THEN round(try_cast(split_part(raw, '/', 1) AS DOUBLE) / nullif(try_cast(split_part(raw, '/', 2) AS DOUBLE), 0), 6) ELSE round(try_cast(nullif(raw, '') AS DOUBLE), 6) END AS rate FROM x""")
def frame_rate_parse(spark, folder):
    k = F.col("o_orderkey")
    raw = F.when(k % 5 == 0, F.concat(k % 97, F.lit("/"), k % 7)).when(k % 5 == 1, F.concat(k, F.lit("000/1001"))).when(k % 5 == 2, F.concat(k % 61, F.lit(".5"))).when(k % 5 == 3, "N/A").otherwise("")
    return table(spark, folder, "orders").select("o_orderkey", raw.alias("raw")).withColumn("rate", scalars.frame_rate(F.col("raw")))


@query("SELECT task_id, round(num_frames / nullif(frame_rate, 0), 6) AS seconds FROM tasks")
def duration(spark, folder):
    return table(spark, folder, "tasks").select("task_id", scalars.duration(F.col("num_frames"), F.col("frame_rate")).alias("seconds"))


@query("""WITH x AS (SELECT o_orderkey, concat(o_orderkey % 1000, CASE o_orderkey % 8 WHEN 0 THEN 'k' WHEN 1 THEN ' MB' WHEN 2 THEN 'g' WHEN 3 THEN '.5T' WHEN 4 THEN '' WHEN 5 THEN 'b' WHEN 6 THEN '.25' ELSE 'kb' END) AS raw FROM orders)
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN (o_orderkey % 1000) * 1024 WHEN 1 THEN (o_orderkey % 1000) * 1048576 WHEN 2 THEN (o_orderkey % 1000) * 1073741824 WHEN 3 THEN ((o_orderkey % 1000) * 2 + 1) * 549755813888 WHEN 4 THEN o_orderkey % 1000 WHEN 7 THEN (o_orderkey % 1000) * 1024 END::BIGINT AS bytes FROM x""")
def size_literal(spark, folder):
    k = F.col("o_orderkey")
    tail = F.element_at(F.array(*[F.lit(x) for x in ("k", " MB", "g", ".5T", "", "b", ".25", "kb")]), (k % 8 + 1).cast("int"))
    return table(spark, folder, "orders").select("o_orderkey", scalars.size_bytes(F.concat(k % 1000, tail)).alias("bytes"))


@query(f"WITH {_MEDIA}, {_META} SELECT m.task_id, coalesce(md.file_size = m.length AND length(md.sha256) = 64, false) AS reused, CASE WHEN md.file_size = m.length AND length(md.sha256) = 64 THEN md.sha256 END AS sha256 FROM m LEFT JOIN md USING (task_id)")
def checksum_reuse(spark, folder):
    return release.reused_digests(_media(spark, folder), _metadata(spark, folder, "file_size", "sha256"), None).select("task_id", "reused", "sha256")


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def document_digests(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("""WITH first AS (SELECT global_id, prompt_id, category, prompt_zh FROM (SELECT global_id, shot_id AS prompt_id, category, prompt_zh, row_number() OVER (PARTITION BY global_id ORDER BY task_id) AS r FROM md0) WHERE r = 1),
g AS (SELECT global_id, coalesce(to_json(list_sort(list(DISTINCT prompt_zh) FILTER (prompt_zh IS NOT NULL)))::VARCHAR, '[]') AS prompt_variants_json, count(DISTINCT prompt_zh)::INT AS prompt_variant_count, to_json(list_sort(list(DISTINCT task_id)))::VARCHAR AS task_ids_json FROM md0 GROUP BY 1),
o AS (SELECT global_id, max(raw_prompt) AS prompt FROM tasks WHERE withdrawn_at IS NOT NULL AND raw_prompt <> '' AND global_id IS NOT NULL GROUP BY 1)
SELECT f.global_id, f.global_id AS prompt_id, f.prompt_id AS shot_id, f.category, coalesce(o.prompt, f.prompt_zh) AS prompt_zh, o.prompt IS NOT NULL AS was_policy_rewritten, prompt_variant_count, prompt_variants_json, task_ids_json
FROM first f JOIN g USING (global_id) LEFT JOIN o USING (global_id)""".replace("WITH first", f"WITH {_META}, md0 AS (SELECT * FROM md WHERE global_id IS NOT NULL), first"))
def prompt_groups(spark, folder):
    replaced = table(spark, folder, "tasks").where("withdrawn_at IS NOT NULL AND raw_prompt <> '' AND global_id IS NOT NULL").groupBy("global_id").agg(F.max("raw_prompt").alias("prompt"))
    return release.prompt_table(_metadata(spark, folder, "global_id", "shot_id", "category", "prompt_zh"), replaced)


@query("SELECT global_id, count(DISTINCT raw_prompt) AS texts FROM tasks WHERE global_id IS NOT NULL AND raw_prompt <> '' GROUP BY 1 HAVING count(DISTINCT raw_prompt) > 1")
def override_conflicts(spark, folder):
    manifest = table(spark, folder, "tasks").select(F.lit("").alias("new_prompt"), F.struct("global_id", "raw_prompt").alias("task"))
    return files.override_conflicts(files.override_rows(manifest))


@query(f"WITH {_STATES} SELECT DISTINCT task_id FROM tasks ANTI JOIN s USING (task_id)")
def missing_state(spark, folder):
    return reconcile.only_left(table(spark, folder, "tasks").select("task_id").distinct(), _state_keys(spark, folder).select("task_id"), ["task_id"])


@query(f"WITH {_STATES} SELECT task_id FROM s ANTI JOIN tasks USING (task_id)")
def extra_state(spark, folder):
    return reconcile.only_left(_state_keys(spark, folder).select("task_id").distinct(), table(spark, folder, "tasks"), ["task_id"])


@query("SELECT task_id FROM tasks EXCEPT SELECT task_id FROM media WHERE removed_at IS NULL")
def missing_media(spark, folder):
    return reconcile.only_left(table(spark, folder, "tasks").select("task_id").distinct(), _media(spark, folder), ["task_id"])


@query(f"WITH {_MEDIA} SELECT task_id, length FROM m ANTI JOIN tasks USING (task_id)")
def extra_media(spark, folder):
    return reconcile.only_left(_media(spark, folder).select("task_id", "length"), table(spark, folder, "tasks"), ["task_id"])


@query("""WITH p AS (SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS l, b.k IS NOT NULL AS r FROM (SELECT DISTINCT task_id AS k FROM tasks) a FULL JOIN (SELECT DISTINCT task_id AS k FROM media) b ON a.k = b.k)
SELECT count(*) FILTER (l) AS left_keys, count(*) FILTER (r) AS right_keys, count(*) FILTER (l AND r) AS "both", count(*) FILTER (NOT r) AS left_only, count(*) FILTER (NOT l) AS right_only FROM p""")
def presence_report(spark, folder):
    return reconcile.cardinalities(table(spark, folder, "tasks"), table(spark, folder, "media"), ["task_id"])


@query(f"WITH {_STATES} SELECT DISTINCT task_id, coalesce(status, '?') AS status FROM (SELECT DISTINCT task_id FROM tasks) LEFT JOIN s USING (task_id) WHERE status IS DISTINCT FROM 'done'")
def not_done(spark, folder):
    held = table(spark, folder, "tasks").select("task_id").distinct().join(_states(spark, folder, "status"), "task_id", "left")
    return held.where(~F.col("status").eqNullSafe("done")).select("task_id", F.coalesce("status", F.lit("?")).alias("status"))


@query(f"WITH {_MEDIA} SELECT m.task_id, m.length, coalesce(min_bytes, 100000) AS floor_bytes FROM m LEFT JOIN profiles p ON p.resolution = split_part(m.task_id, '_', -1) WHERE m.length < coalesce(min_bytes, 100000) AND m.task_id IN (SELECT task_id FROM tasks)")
def small_files(spark, folder):
    held = reconcile.within(_media(spark, folder), table(spark, folder, "tasks"), ["task_id"]).withColumn("resolution", scalars.last_part(F.col("task_id")))
    floor = held.join(F.broadcast(table(spark, folder, "profiles").select("resolution", "min_bytes")), "resolution", "left").withColumn("floor_bytes", F.coalesce("min_bytes", F.lit(100_000)))
    return floor.where("length < floor_bytes").select("task_id", "length", "floor_bytes")


@query(f"WITH {_MEDIA} SELECT count(*) AS files, sum(length)::BIGINT AS bytes FROM m WHERE task_id IN (SELECT task_id FROM tasks)")
def byte_total(spark, folder):
    return reconcile.within(_media(spark, folder), table(spark, folder, "tasks"), ["task_id"]).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("SELECT file_name, count(*) AS rows FROM checksums GROUP BY 1 HAVING count(*) > 1")
def dup_keys(spark, folder):
    return keys.duplicates(table(spark, folder, "checksums"), "file_name")


@query("SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem)) + (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)) = 0 AS equal")
def set_equality(spark, folder):
    return reconcile.same_set(table(spark, folder, "orders").select(F.col("o_orderkey").alias("k")), table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


@query("SELECT o_orderkey FROM orders INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def set_intersection(spark, folder):
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return reconcile.within(table(spark, folder, "orders").select("o_orderkey"), returned, ["o_orderkey"])


@query("SELECT coalesce(status, '?') AS status, count(*) AS reports FROM state GROUP BY 1")
def status_counts(spark, folder):
    return profiling.status_counts(table(spark, folder, "state"))


@query(f"""WITH {_STATES} SELECT split_part(task_id, '_', 1) AS account, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'failed') AS failed,
count(*) FILTER (status = 'permanent_failed') AS permanent_failed, count(*) FILTER (coalesce(status, '') NOT IN ('done', 'running', 'failed', 'permanent_failed')) AS other, count(*) AS total FROM s GROUP BY 1""")
def status_matrix(spark, folder):
    return profiling.matrix(_states(spark, folder, "status").withColumn("account", scalars.first_part(F.col("task_id"))), "account", "status", ["done", "running", "failed", "permanent_failed"], "other")


@query(f"WITH {_STATES}, n AS (SELECT count(DISTINCT task_id) AS planned FROM tasks) SELECT planned AS expected, count(*) FILTER (status = 'done') AS done, count(*) AS touched, greatest(0, planned - count(*)) AS untouched, round(count(*) FILTER (status = 'done') / planned * 100, 1) AS percent_done FROM s, n GROUP BY planned")
def progress(spark, folder):
    return profiling.progress(_states(spark, folder, "status"), table(spark, folder, "tasks").select("task_id").distinct())


@query("SELECT account, string_agg(resolution || '=' || n, ',' ORDER BY resolution) AS counts FROM (SELECT coalesce(account, '?') AS account, coalesce(resolution, '?') AS resolution, count(*) AS n FROM tasks GROUP BY 1, 2) GROUP BY 1")
def nested_counts(spark, folder):
    df = profiling.nested_counts(table(spark, folder, "tasks"), "account", "resolution")
    return df.select("account", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query("""WITH g AS (SELECT global_id, count(*) AS n FROM metadata WHERE global_id IS NOT NULL GROUP BY 1), k AS (SELECT coalesce(a.shot_id, b.d) AS key, a.n, b.d IS NOT NULL AS known FROM (SELECT shot_id, count(*) AS n FROM metadata GROUP BY 1) a FULL JOIN (SELECT unnest(range(1, 11))::INT AS d) b ON a.shot_id = b.d)
SELECT 'prompt_groups' AS rule_id, 'error' AS severity, global_id::VARCHAR AS subject, 'rows: ' || n || ', expected 3' AS detail FROM g WHERE n <> 3
UNION ALL SELECT 'shots', 'error', coalesce(key::VARCHAR, 'null'), CASE WHEN known THEN 'rows: ' || coalesce(n, 0) ELSE 'not in the domain' END FROM k WHERE NOT known OR coalesce(n, 0) <> 300""")
def group_shape(spark, folder):
    md = table(spark, folder, "metadata")
    return rules.together(rules.group_shape(md, "prompt_groups", "global_id", None, 3), rules.key_domain(md, "shots", "shot_id", range(1, 11), 300))


_PAIRS = " || ".join(f"CASE WHEN md.{a}::DOUBLE IS DISTINCT FROM p.{b}::DOUBLE THEN ',{a}' ELSE '' END" for a, b in checks.MEASURED)


@query(f"SELECT 'measured_values' AS rule_id, 'error' AS severity, task_id AS subject, detail FROM (SELECT md.task_id, CASE WHEN p.resolution IS NULL THEN 'unknown resolution' ELSE ltrim({_PAIRS}, ',') END AS detail FROM metadata md LEFT JOIN profiles p USING (resolution)) WHERE detail <> ''")
def measured_values(spark, folder):
    known = table(spark, folder, "profiles").select("resolution", *[F.col(b).cast("double").alias(b) for _, b in checks.MEASURED])
    values = table(spark, folder, "metadata").select("task_id", "resolution", *[F.col(a).cast("double").alias(a) for a, _ in checks.MEASURED])
    return rules.matches_lookup(values, "measured_values", "task_id", known, "resolution", checks.MEASURED)


@query(f"WITH {_MEDIA} SELECT split_part(task_id, '_', -1) AS resolution, count(*) AS files, (sum(length) // count(*))::BIGINT AS mean_bytes, percentile_disc(0.5) WITHIN GROUP (ORDER BY length DESC) AS median_bytes, min(length) AS least_bytes, max(length) AS most_bytes FROM m WHERE length IS NOT NULL GROUP BY 1")
def size_stats(spark, folder):
    return profiling.size_distribution(_media(spark, folder).withColumn("resolution", scalars.last_part(F.col("task_id"))), "resolution", "length")


def _packed(spark, folder):
    return packing.next_fit(_metadata(spark, folder, "file_size"), ["task_id"], "file_size", CAPACITY)


_PLAN = f"""RECURSIVE {_META}, o AS MATERIALIZED (SELECT task_id, file_size, coalesce(file_size, 0) AS size, row_number() OVER (ORDER BY task_id) AS rn FROM md),
w AS (SELECT rn, task_id, file_size, size AS used, 0::BIGINT AS shard_no FROM o WHERE rn = 1
 UNION ALL SELECT o.rn, o.task_id, o.file_size, CASE WHEN w.used + o.size > {CAPACITY} THEN o.size ELSE w.used + o.size END, CASE WHEN w.used + o.size > {CAPACITY} THEN w.shard_no + 1 ELSE w.shard_no END FROM w JOIN o ON o.rn = w.rn + 1)"""


@query(f"WITH {_PLAN} SELECT task_id, file_size, shard_no FROM w")
def shard_plan(spark, folder):
    return _packed(spark, folder)


@query(f"WITH {_PLAN} SELECT printf('shards/train-%05d.tar', shard_no) AS shard, count(*) AS items, sum(file_size)::BIGINT AS bytes, min(task_id) AS first_key, max(task_id) AS last_key FROM w GROUP BY shard_no")
def shard_index(spark, folder):
    return packing.shard_summary(_packed(spark, folder), "task_id", "file_size").select(scalars.shard_name(F.col("shard_no")).alias("shard"), "items", "bytes", "first_key", "last_key")


@query(f"WITH {_PLAN} SELECT task_id, 'videos/' || task_id || '.mp4' AS file_name, printf('shards/train-%05d.tar', shard_no) AS shard, w.file_size FROM w")
def location_refresh(spark, folder):
    source = _metadata(spark, folder, "file_name", "shard", "file_size")
    packed = cut(_packed(spark, folder))
    staged = packed.select("task_id", F.concat(F.lit("videos/"), "task_id", F.lit(".mp4")).alias("file_name"), scalars.shard_name(F.col("shard_no")).alias("shard"))
    return reconcile.refreshed(source, staged, "task_id", ["file_name", "shard"])


@query("""WITH p AS (SELECT coalesce(a.task_id, b.task_id) AS task_id, a.task_id IS NOT NULL AS l, b.task_id IS NOT NULL AS r FROM (SELECT DISTINCT task_id FROM metadata) a FULL JOIN (SELECT DISTINCT task_id FROM media) b ON a.task_id = b.task_id)
SELECT split_part(task_id, '_', 1) AS account, task_id, CASE WHEN l THEN 'missing' ELSE 'extra' END AS finding FROM p WHERE NOT (l AND r)""")
def member_rows(spark, folder):
    of = lambda n: table(spark, folder, n).select(scalars.first_part(F.col("task_id")).alias("account"), "task_id")
    return reconcile.member_differences(of("metadata"), of("media"), "account", "task_id")


@query("SELECT split_part(line, '  ', 1) AS sha256, substr(line, strpos(line, '  ') + 2) AS file_name FROM (SELECT coalesce(sha256, '') || '  ' || coalesce(file_name, '') AS line FROM checksums) WHERE strpos(line, chr(13)) = 0")
def checksum_manifest(spark, folder):
    line = F.concat(F.coalesce("sha256", F.lit("")), F.lit("  "), F.coalesce("file_name", F.lit("")))
    return files.manifest_lines(table(spark, folder, "checksums").select(line.alias("value")))


@query(f"""WITH {_META}, c AS (SELECT file_name, arg_max(coalesce(sha256, ''), line_no) AS sha256 FROM checksums GROUP BY 1), a AS (SELECT file_name, max(coalesce(sha256, '')) AS sha256 FROM md GROUP BY 1)
SELECT 'checksums' AS rule_id, 'error' AS severity, coalesce(a.file_name, c.file_name) AS subject, coalesce(a.sha256, 'null') || ' / ' || coalesce(c.sha256, 'null') AS detail FROM a FULL JOIN c ON a.file_name = c.file_name WHERE a.sha256 IS DISTINCT FROM c.sha256""")
def manifest_matches(spark, folder):
    md = _metadata(spark, folder, "file_name", "sha256").groupBy("file_name").agg(F.max(F.coalesce("sha256", F.lit(""))).alias("sha256"))
    said = table(spark, folder, "checksums").groupBy("file_name").agg(F.max_by(F.coalesce("sha256", F.lit("")), "line_no").alias("sha256"))
    return rules.same_values(md, said, "checksums", "file_name", "sha256")


_RULES = f"""WITH {_STATES}, {_MEDIA}, ids AS (SELECT DISTINCT task_id FROM tasks), v AS (
SELECT 'duplicate_task' AS rule_id, 'error' AS severity, task_id AS subject, 'rows: ' || count(*) AS detail FROM tasks GROUP BY task_id HAVING count(*) > 1
UNION ALL SELECT 'missing_state', 'error', task_id, 'no report' FROM ids ANTI JOIN s USING (task_id)
UNION ALL SELECT 'missing_video', 'error', task_id, 'no file' FROM ids ANTI JOIN m USING (task_id)
UNION ALL SELECT 'not_done', 'error', task_id, coalesce(status, '?') FROM ids LEFT JOIN s USING (task_id) WHERE status IS DISTINCT FROM 'done'
UNION ALL SELECT 'small_or_empty', 'error', task_id, length::VARCHAR FROM m SEMI JOIN ids USING (task_id) WHERE coalesce(length, 0) < 1024
UNION ALL SELECT 'extra_state', 'warn', task_id, 'state of no task' FROM s ANTI JOIN ids USING (task_id)
UNION ALL SELECT 'extra_video', 'warn', task_id, 'video of no task' FROM m ANTI JOIN ids USING (task_id))"""


@query(f"{_RULES} SELECT * FROM v")
def rule_violations(spark, folder):
    return checks.project_violations(table(spark, folder, "tasks"), _states(spark, folder, "status"), _media(spark, folder))


@query(f"{_RULES} SELECT count(*) FILTER (severity = 'error') = 0 AS ok, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warn') AS warnings FROM v")
def rule_verdict(spark, folder):
    return rules.verdict(rule_violations(spark, folder))


@query(f"{_RULES}, r AS (SELECT rule_id, severity, subject, dense_rank() OVER (PARTITION BY rule_id, severity ORDER BY subject) AS k FROM v) SELECT rule_id, severity, count(*) AS violations, string_agg(DISTINCT subject, ',' ORDER BY subject) FILTER (k <= 20) AS subjects FROM r GROUP BY 1, 2")
def rule_samples(spark, folder):
    return rules.samples(rule_violations(spark, folder)).withColumn("subjects", F.array_join("subjects", ","))


@query("SELECT file_stem, status, retries, loaded_at FROM state WHERE status IN ('failed', 'permanent_failed') ORDER BY loaded_at DESC, file_stem LIMIT 20")
def failures_topn(spark, folder):
    failed = table(spark, folder, "state").where(F.col("status").isin("failed", "permanent_failed"))
    return failed.orderBy(F.desc("loaded_at"), "file_stem").limit(20).select("file_stem", "status", "retries", "loaded_at")


@query("SELECT lang AS value, count(*) AS rows FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def value_counts(spark, folder):
    return profiling.value_counts(table(spark, folder, "documents"), "lang")


@query("SELECT event_type, count(*) AS events, sum(try_cast(props->>'$.k' AS BIGINT))::BIGINT AS total_k FROM events GROUP BY 1")
def json_props(spark, folder):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("events"), F.sum(k).alias("total_k"))


@query("SELECT task_id, coalesce(nullif(account, ''), split_part(task_id, '_', 1)) AS account, split_part(task_id, '_', -1) AS resolution FROM tasks")
def key_parts(spark, folder):
    return table(spark, folder, "tasks").select("task_id", scalars.owner(F.col("account"), F.col("task_id")).alias("account"), scalars.last_part(F.col("task_id")).alias("resolution"))


@query("SELECT coalesce(task_id, '') AS task_id, coalesce(account, '') AS account, coalesce(status, '') AS status, coalesce(video_id, '') AS video_id, coalesce(output_path, '') AS output_path, coalesce(started_at, '') AS started_at, coalesce(completed_at, '') AS completed_at, coalesce(retries::VARCHAR, '') AS retries, coalesce(error, '') AS error FROM state")
def stats_rows(spark, folder):
    return table(spark, folder, "state").select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in schemas.columns(schemas.STATS)])


@query(r"""SELECT task_id, output_path FROM (SELECT *, nullif(regexp_extract(trim(output_path), '[^/\\]*$'), '') AS leaf FROM s WHERE status = 'done') x
WHERE NOT EXISTS (SELECT 1 FROM media WHERE nullif(regexp_extract(trim(path), '[^/\\]*$'), '') = x.leaf)""".replace("SELECT task_id", f"WITH {_STATES} SELECT task_id", 1))
def outputs_missing(spark, folder):
    return checks.outputs_missing(_states(spark, folder, "status", "output_path"), table(spark, folder, "media"))


@query("SELECT count(*) AS rows, count(DISTINCT global_id) AS prompts, count(*) FILTER (media_metadata_source = 'ffprobe_cache') AS probed_rows, round(sum(file_size) / 1073741824.0, 3) AS gib FROM metadata")
def release_counts(spark, folder):
    md = table(spark, folder, "metadata")
    return md.agg(F.count("*").alias("rows"), F.count_distinct("global_id").alias("prompts"), F.count_if(F.col("media_metadata_source") == "ffprobe_cache").alias("probed_rows"), F.round(scalars.gib(F.sum("file_size")), 3).alias("gib"))




@query("SELECT path, 3::BIGINT AS boxes, 'ftyp,moov,mdat' AS kinds, (8 + length(path) % 50)::BIGINT AS mdat_size FROM media WHERE path IS NOT NULL")
def mp4_boxes(spark, folder):
    n = F.length("path") % 50
    ab = lambda s: F.hex(F.lit(s))
    content = F.unhex(F.concat(F.lit("00000014"), ab("ftyp"), F.repeat(F.lit("00"), 12), F.lit("0000000C"), ab("moov"), F.lit("00000000"), F.lpad(F.hex(n + 8), 8, "0"), ab("mdat"), F.expr("repeat('AB', length(path) % 50)")))
    df = table(spark, folder, "media").where("path IS NOT NULL").select("path", content.alias("content")).withColumn("b", containers.boxes_of(F.col("content")))
    return df.select("path", F.size("b").cast("bigint").alias("boxes"), F.array_join("b.btype", ",").alias("kinds"), scalars.u32(F.col("content"), 33).alias("mdat_size"))
