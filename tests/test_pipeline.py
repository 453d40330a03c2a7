"""A small project from prompts to validated shards, then one defect after the other."""

import json
import os
import shutil
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from tessera import cli, schemas
from tessera.operators.keys import DuplicateKeys
from tessera.operators.reconcile import Mismatch
from tessera.plans import checks, release
from tessera.sources import containers, files, sinks
from tessera.streaming import progress

SHAPE = checks.Shape(36, 12, 3, (1, 2, 3, 4, 5, 6), 6, 12)


def box(kind, payload=b""):
    return struct.pack(">I", 8 + len(payload)) + kind + payload


def mp4(n=2000):
    return box(b"ftyp", b"isom") + box(b"moov", b"m" * 40) + box(b"mdat", b"x" * n)


def lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("project"))
    with open(f"{root}/prompts.csv", "w", encoding="utf-8-sig") as f:
        f.write("category,prompt_id,raw_prompt\n")
        f.writelines(f'cat{c},{s},"prompt {c}-{s}, ""quoted"",\nsecond line 世界",extra\n' for c in range(2) for s in range(1, 7))
        f.write("\ncat9,x,not a shot\ntwo,cells\n")
    os.makedirs(f"{root}/tasks/tasks_Z.jsonl")  # of an earlier run
    load = cli.generate_tasks(spark, f"{root}/prompts.csv", f"{root}/tasks").collect()
    assert sum(r["tasks"] for r in load) == 36
    assert sorted(n for n in os.listdir(f"{root}/tasks") if not n.startswith(".")) == [f"tasks_{a}.jsonl" for a in "ABCDEFGHIJ"]
    tasks = [r.asDict() for r in spark.read.schema(schemas.TASKS).json(f"{root}/tasks/tasks_*.jsonl").collect()]
    for i, t in enumerate(tasks):
        os.makedirs(f"{root}/state", exist_ok=True)
        with open(f"{root}/state/{t['task_id']}.json", "w") as f:
            json.dump({"task_id": t["task_id"] if i else "", "account": t["account"], "status": "done", "retries": 1, "output_path": f"output/{t['task_id']}.mp4", "repaired_at": "x" if i == 3 else None, "error": None}, f, indent=1)
        os.makedirs(f"{root}/output", exist_ok=True)
        with open(f"{root}/output/{t['task_id']}.mp4", "wb") as f:
            f.write(mp4(1000 + 10 * i))
    sizes = {p[0]: p for p in schemas.PROFILES}
    with open(f"{root}/probe.csv", "w") as f:
        f.write("task_id,width,height,frame_rate,duration_seconds,num_frames\n")
        for t in tasks:
            p = sizes[t["resolution"]]
            f.write(f"{t['task_id']},{p[5]},{p[6]},24/1,{p[7]},{p[3]}\n")
    gid = tasks[0]["global_id"]
    lines(f"{root}/rerun_policy16_manifest.jsonl", [{"task_id": tasks[0]["task_id"], "new_prompt": "other words", "task": {"global_id": gid, "raw_prompt": "x"}}, {"task_id": tasks[1]["task_id"], "new_prompt": "", "task": {"global_id": None, "raw_prompt": "y"}}])
    lines(f"{root}/rerun_99_state_backup_a.jsonl", [{"task_id": "old"}])
    lines(f"{root}/rerun_99_state_backup_b.jsonl", [{"task_id": tasks[0]["task_id"]}, {"task_id": tasks[2]["task_id"]}, {"task_id": ""}])
    counts = cli.build_metadata(spark, root, f"{root}/release", probe_cache=f"{root}/probe.csv").first()
    assert (counts["files"], counts["reused_digests"]) == (36, 0)
    return root, sorted(t["task_id"] for t in tasks), tasks


def test_metadata(spark, project):
    root, ids, tasks = project
    table = {r["task_id"]: r for r in files.json_lines(spark, f"{root}/release/metadata.jsonl", schemas.METADATA).collect()}
    assert sorted(table) == ids and len(table[ids[0]].asDict()) == 33
    stage = {t["task_id"]: table[t["task_id"]]["repair_stage"] for t in tasks}
    assert [stage[tasks[i]["task_id"]] for i in range(5)] == ["policy16_prompt_rewrite", "policy16_prompt_rewrite", "rerun_99", "state_repair", "initial"]
    r = table[ids[0]]
    assert (r["prompt_id"], r["media_metadata_source"], r["actual_frame_rate"], len(r["sha256"]), r["retries"]) == (r["global_id"], "ffprobe_cache", 24.0, 64, 1)
    assert "\nsecond line 世界" in r["prompt_zh"]
    assert files.csv_rows(spark, f"{root}/release/metadata.csv") == 36
    prompts = spark.read.schema(schemas.PROMPTS).option("header", True).option("multiLine", True).option("escape", '"').csv(f"{root}/release/prompts.csv").collect()
    assert len(prompts) == 12 and [p["prompt_zh"] for p in prompts if p["was_policy_rewritten"]] == ["other words"]
    assert all(len(json.loads(p["task_ids_json"])) == 3 for p in prompts)
    again = cli.build_metadata(spark, root, f"{root}/release2", probe_cache=f"{root}/probe.csv", reuse=f"{root}/release/metadata.jsonl").first()
    assert (again["files"], again["reused_digests"]) == (36, 36)
    values = release.measured(files.tasks(spark, f"{root}/tasks"), files.probe_cache(spark, None), None, schemas.profiles(spark))
    assert {r["media_metadata_source"] for r in values.collect()} == {"observed_resolution_profile"}
    blank = cli.build_metadata(spark, root, f"{root}/release3", sha256=False, reuse=f"{root}/release/metadata.jsonl").first()
    assert (blank["files"], blank["reused_digests"]) == (36, 0) and not os.path.exists(f"{root}/release3/checksums.sha256")
    assert {r["lines"] for r in files.account_lines(spark, f"{root}/tasks").collect()} == {3, 6} or sum(r["lines"] for r in files.account_lines(spark, f"{root}/tasks").collect()) == 36


@pytest.fixture(scope="module")
def staged(spark, project):
    root, ids, _ = project
    index = cli.make_shards(spark, root, f"{root}/staged", "6k").collect()
    assert sum(r["num_videos"] for r in index) == 36 and len(index) > 5
    return f"{root}/staged"


def test_shards(spark, project, staged):
    root, ids, _ = project
    index = [r.asDict() for r in files.shard_index(spark, f"{staged}/shard_index.json").orderBy("shard").collect()]
    names = []
    for r in index:
        with tarfile.open(f"{staged}/{r['shard']}") as t:
            names += t.getnames()
            assert len(t.getnames()) == r["num_videos"] and os.path.getsize(f"{staged}/{r['shard']}") == r["size_bytes"]
    assert names == [f"videos/{i}.mp4" for i in ids]
    with pytest.raises(sinks.NotEmpty):
        cli.make_shards(spark, root, staged)
    said = cli.validate_staging(spark, staged, shape=SHAPE)
    assert said["ok"] and said["parquet_exists"] and said["parquet_size_bytes"] > 0 and said["errors"] == 0 and said["problems"] == {}, said
    assert (said["num_videos"], said["num_prompts"], said["num_shards"], said["tar_video_count"], said["checksums_rows"], said["metadata_csv_rows"], said["prompts_csv_rows"], said["full_media_probe_rows"]) == (36, 12, len(index), 36, 36, 36, 12, 36)
    assert said["profile_counts"] == {"1080p": 12, "480p": 12, "720p": 12}
    cli.make_shards(spark, root, staged, refresh_only=True)
    assert cli.validate_staging(spark, staged, shape=SHAPE)["ok"]


def problems(spark, staged):
    said = cli.validate_staging(spark, staged, shape=SHAPE)
    assert not said["ok"]
    return set(said["problems"])


def changed(spark, staged, tmp_path, change):
    """A copy of the staged release with its metadata changed."""
    copy = str(tmp_path / "copy")
    shutil.copytree(staged, copy)
    table = files.json_lines(spark, f"{staged}/metadata.jsonl", schemas.METADATA)
    sinks.json_table(change(table), f"{copy}/metadata.jsonl", ["task_id"])
    return copy


DEFECTS = [
    (lambda t: t.unionByName(t.limit(1)), {"unique_task", "prompt_groups", "shots", "profiles", "metadata_rows", "csv_rows"}),
    (lambda t: t.withColumn("actual_width", F.when(F.col("global_id") == 0, 1).otherwise(F.col("actual_width"))), {"measured_values"}),
    (lambda t: t.withColumn("actual_height", F.when(F.col("global_id") == 0, F.lit(None)).otherwise(F.col("actual_height"))), {"measured_values"}),
    (lambda t: t.withColumn("media_metadata_source", F.when(F.col("global_id") == 0, "ffprobe").otherwise(F.col("media_metadata_source"))), {"media_source"}),
    (lambda t: t.withColumn("sha256", F.when(F.col("global_id") == 0, "").otherwise(F.col("sha256"))), {"digest", "checksums"}),
]


@pytest.mark.parametrize("k", range(len(DEFECTS)))
def test_table_defects(spark, staged, tmp_path, k):
    change, want = DEFECTS[k]
    assert problems(spark, changed(spark, staged, tmp_path, change)) == want


def test_file_defects(spark, staged, tmp_path):
    copy = str(tmp_path / "copy")
    shutil.copytree(staged, copy)
    with open(f"{copy}/shards/train-00000.tar", "ab") as f:
        f.write(b"\0" * 512)
    os.remove(f"{copy}/shards/train-00001.tar")
    with tarfile.open(f"{copy}/shards/train-00002.tar", "a") as t:
        t.add(f"{copy}/shard_index.json", "videos/odd.mp4")
    os.remove(f"{copy}/.shard_index.json.crc")
    with open(f"{copy}/shard_index.json") as f:
        index = json.load(f)
    with open(f"{copy}/shard_index.json", "w") as f:
        json.dump(index[:-1], f)
    assert problems(spark, copy) == {"shard_size", "shard_file", "shard_members", "shard_set"}
    with pytest.raises(Mismatch):
        sub = changed(spark, staged, tmp_path / "s", lambda t: t.limit(35))
        cli.refreshed(files.json_lines(spark, f"{staged}/metadata.jsonl", schemas.METADATA), files.json_lines(spark, f"{sub}/metadata.jsonl", schemas.METADATA), "task_id", ["shard"])


def test_project_defects(spark, project, tmp_path):
    root, ids, tasks = project
    copy = str(tmp_path / "p")
    for d in ("tasks", "state", "output"):
        shutil.copytree(f"{root}/{d}", f"{copy}/{d}")
    good = cli.validate_dataset(spark, copy, 100)
    assert good["ok"] and good["counts"]["tasks"] == good["counts"]["task_mp4"] == 36 and sum(good["by_account"]["A"].values()) == 6 and good["by_resolution"] == {"1080p": 12, "480p": 12, "720p": 12}, good
    os.remove(f"{copy}/state/{ids[1]}.json")
    os.remove(f"{copy}/output/{ids[2]}.mp4")
    with open(f"{copy}/output/{ids[3]}.mp4", "wb") as f:
        f.write(b"0123456789")
    for name, text in ((ids[4], '{"status": "running"}'), ("Z_g1_720p", '{"status": "done"}'), ("broken", '{"stat')):
        with open(f"{copy}/state/{name}.json", "w") as f:
            f.write(text)
    shutil.copy(f"{copy}/output/{ids[5]}.mp4", f"{copy}/output/stray.mp4")
    said = cli.validate_dataset(spark, copy, 100)
    assert not said["ok"] and said["problems"] == {"missing_state": 1, "not_done": 2, "missing_video": 1, "small_or_empty": 1, "extra_state": 1, "extra_video": 1}
    assert [r["file"] for r in files.states(spark, f"{copy}/state")[1].collect()] == ["broken.json"]
    with pytest.raises(release.Incomplete):
        cli.build_metadata(spark, copy, f"{copy}/release")
    sound, sizes, lost = cli.verify(spark, copy)
    by = {r["task_id"]: r["issues"] for r in sound.collect()}
    assert "no moov" in by[ids[3]] and by[ids[6]] == ["too small"]
    assert [r["task_id"] for r in lost.orderBy("task_id").collect()] == sorted([ids[2], "Z_g1_720p"])
    assert said["samples"]["not_done"] == sorted([ids[1], ids[4]]) and spark.read.json(f"{copy}/release/validation_report.json.violations").count() == 7
    overall, by_account, failed = cli.summarize(spark, copy, f"{copy}/stats.csv")
    assert failed.count() == 0 and by_account.where("account = 'Z'").first()["tasks"] == 1
    assert overall.first()["planned"] == 36 and overall.first()["done"] == 35 and files.csv_rows(spark, f"{copy}/stats.csv") == 36
    with open(f"{copy}/tasks/tasks_Z.jsonl", "w") as f:
        f.write(json.dumps({**tasks[0], "category": "later"}) + "\n\n")
    assert files.tasks(spark, f"{copy}/tasks").where("category = 'later'").count() == 1
    for strict in (lambda: files.tasks(spark, f"{copy}/tasks", strict=True), lambda: cli.validate_dataset(spark, copy, 100)):
        with pytest.raises(DuplicateKeys):
            strict()
    shutil.copy(f"{copy}/state/{ids[6]}.json", f"{copy}/state/again.json")
    assert cli.summarize(spark, copy, f"{copy}/stats.csv")[0].first()["touched"] == 37 == files.csv_rows(spark, f"{copy}/stats.csv")


def test_probe_asks_for_the_mean_rate(tmp_path):
    stub = tmp_path / "ffprobe"
    stub.write_text('#!/bin/sh\necho "$@" > "$(dirname "$0")/asked"\necho \'{"streams": [{"width": 4, "height": 2, "r_frame_rate": "30/1", "avg_frame_rate": "24000/1001", "duration": "2.5", "nb_frames": "60"}], "format": {"duration": "9"}}\'\n')
    stub.chmod(0o755)
    assert containers.ffprobe("a.mp4", str(stub)) == {"width": 4, "height": 2, "frame_rate": "24000/1001", "duration_seconds": "2.5", "num_frames": "60"}
    assert "r_frame_rate" not in (tmp_path / "asked").read_text().replace("avg_frame_rate", "")


def test_root(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert cli.project_root() == "."
    (tmp_path / "worker" / "tasks").mkdir(parents=True)
    assert cli.project_root() == "worker" and cli.project_root(("release/metadata.jsonl", "output"), cli.RELEASED) == "."
    for name in ("tasks", "state", "output"):
        (tmp_path / name).mkdir()
    assert cli.project_root() == "."


def test_many_profiles(spark, monkeypatch):
    from tessera.plans import tasks as plan

    prompts = spark.createDataFrame([(i, 1, "c", f"p{i}") for i in range(7)], "global_id int, prompt_id int, category string, raw_prompt string")
    profiles = spark.createDataFrame([(f"r{k}", k, k, 10, 24) for k in range(9)], "resolution string, width int, height int, num_frames int, frame_rate int")
    want = sorted(map(tuple, plan.task_table(prompts, profiles).collect()))
    for limit, send in ((4, 100), (4, 1), (9, 1)):
        monkeypatch.setattr(plan, "IN_PLAN", limit)
        monkeypatch.setattr(plan, "BROADCAST", send)
        assert sorted(map(tuple, plan.task_table(prompts, profiles).collect())) == want and len(want) == 63


def test_overrides_conflict(spark, tmp_path):
    lines(f"{tmp_path}/m.jsonl", [{"new_prompt": "a", "task": {"global_id": 1}}, {"new_prompt": "b", "task": {"global_id": 1}}])
    with pytest.raises(files.ConflictingOverrides):
        files.prompt_overrides(spark, f"{tmp_path}/m.jsonl")
    assert files.prompt_overrides(spark, None).count() == 0


def test_boxes(spark, tmp_path):
    big = box(b"ftyp") + struct.pack(">I", 1) + b"mdat" + struct.pack(">Q", 16 + 300_000) + b"x" * 300_000 + box(b"moov", b"y" * 9)
    late = box(b"ftyp") + box(b"moov", b"m" * 5000) + box(b"mdat", b"x" * 250_000)
    cases = {"big": big, "late": late, "open": box(b"ftyp") + struct.pack(">I", 0) + b"mdat" + b"moov" * 3, "empty": b"", "text": b"hello world, no boxes"}
    for n, b in cases.items():
        with open(f"{tmp_path}/{n}.mp4", "wb") as f:
            f.write(b)
    media = files.media_listing(spark, str(tmp_path))
    kinds = lambda mode: {r["task_id"]: [b["btype"] for b in r["boxes"]] for r in containers.with_boxes(media, "path", mode).collect()}
    seek = kinds("seek")
    assert seek["big"] == ["ftyp", "mdat", "moov"] and seek["late"] == ["ftyp", "moov", "mdat"] and seek["open"] == ["ftyp", "mdat"] and seek["empty"] == []
    head = kinds("head")
    assert head["late"] == ["ftyp", "moov"] and head["open"] == ["ftyp", "mdat", "moov"] and head["big"] == ["ftyp", "mdat", "moov"]
    sound = {r["task_id"]: list(r["issues"]) for r in containers.integrity(containers.with_boxes(media), schemas.profiles(spark)).collect()}
    assert sound["big"] == [] and sound["late"] == [] and sound["empty"] == ["missing or empty"] and "no ftyp" in sound["text"]
    digest = {r["task_id"]: r["sha256"] for r in containers.digests(media).collect()}
    import hashlib

    assert digest["big"] == hashlib.sha256(big).hexdigest()
    probe = lambda path: {"width": 7, "frame_rate": "24/1"} if "big" in path else {}
    assert [tuple(r)[:4] for r in containers.probed(media, probe).collect()] == [("big", "7", None, "24/1")]
    assert containers.ffprobe("/nowhere", "no-such-program") == {}


def test_json_lines(spark, tmp_path):
    with open(f"{tmp_path}/t.jsonl", "w", encoding="utf-8") as f:
        f.write('{"task_id": "a b"}\n\n{"task_id": "c"}\n{"task_id": \n')
    assert files.json_lines(spark, f"{tmp_path}/t.jsonl", "task_id string", strict=False).count() == 3
    with pytest.raises(Exception, match="t.jsonl"):
        files.json_lines(spark, f"{tmp_path}/t.jsonl", "task_id string").collect()


def test_stream(spark, project, tmp_path):
    root, ids, _ = project
    reports = progress.report_stream(spark, f"{root}/state")
    q = progress.status_stream(reports).writeStream.outputMode("complete").format("memory").queryName("statuses").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(60)
    assert {r["status"]: r["reports"] for r in spark.table("statuses").collect()} == {"done": 36}
    w = progress.status_by_window(reports).writeStream.outputMode("append").format("memory").queryName("windows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "w")).start()
    w.awaitTermination(60)
    assert w.exception() is None
