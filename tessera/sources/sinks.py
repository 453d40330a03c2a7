"""Sinks: text and Parquet tables, manifests, tar shards, reports. Null becomes blank only here."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import shard_name
from tessera.session import cut, shuffle_partitions
from tessera.sources.containers import opened, storage
from tessera.sources.files import _path, matches


class NotEmpty(ValueError):
    """The destination holds files and overwriting was not asked for."""


def prepare(spark: SparkSession, folder: str, force: bool = False) -> None:
    """An empty destination: files in it raise NotEmpty, with force all of it goes."""
    p, fs = _path(spark, folder)
    if fs.exists(p):
        if len(fs.listStatus(p)) and not force:
            raise NotEmpty(folder)
        fs.delete(p, True)
    fs.mkdirs(p)


def tasks_by_account(tasks: DataFrame, folder: str) -> None:
    """JSON lines, ``tasks_<account>.jsonl`` per account, which the readers of tasks find; the account also stays in the lines.

    Each is a folder of parts in order of the tasks: ranges of account and number, so that an account is written by many tasks. Task files of an earlier run are
    replaced, other files of the folder stay. A null account is named ``null``."""
    order = ("_account", "global_id", "task_id")
    named = tasks.withColumn("_account", F.coalesce("account", F.lit("null")))
    made, fs = _path(spark := tasks.sparkSession, f"{folder}/_tasks.part")
    named.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("_account").option("ignoreNullFields", False).json(str(made))
    for old in matches(spark, f"{folder}/tasks_*.jsonl"):
        fs.delete(_path(spark, old)[0], True)
    for at in matches(spark, f"{made}/_account=*"):  # one folder per account
        fs.rename(_path(spark, at)[0], _path(spark, f"{folder}/tasks_{unquote(at.rpartition('_account=')[2])}.jsonl")[0])
    fs.delete(made, True)


def csv_table(df: DataFrame, path: str, fields: Sequence[str] | None = None, order: Sequence[str] = ()) -> None:
    """A CSV with a header and the given fields; null and missing fields are blank, quotes are doubled, blanks around values stay. order: range-sorted over the files, whose names are in order."""
    names = list(fields or df.columns)
    placed = df.orderBy(*order) if order else df
    placed = placed.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in names])
    placed.write.mode("overwrite").option("header", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("quote", '"').option("escape", '"').csv(path)


def json_table(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """JSON lines with all fields; null is written. order: range-sorted over the files."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def checksum_lines(df: DataFrame, path: str, name: str = "file_name", digest: str = "sha256") -> bool:
    """Lines ``<digest>  <path>`` in order of the path; a missing digest is left out, without any no file is written (False)."""
    held = df.where(F.col(digest) != "")
    if held.isEmpty():
        return False
    held.orderBy(name).select(F.concat(digest, F.lit("  "), name)).write.mode("overwrite").text(path)
    return True


def parquet_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Typed columns as they are; written after packing, so that shard and file name are those of the release."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def report(spark: SparkSession, path: str, df: DataFrame) -> dict:
    """A table of one row as a JSON document; returned too."""
    said = json.loads(df.limit(1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0])
    write_text(spark, path, json.dumps(said, ensure_ascii=False, indent=2) + "\n")
    return said


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text written beside its place and then renamed."""
    p, fs = _path(spark, path)
    part, _ = _path(spark, path + ".part")
    out = fs.create(part, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    fs.delete(p, False)
    fs.rename(part, p)


def copy_side_files(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> list[str]:
    """Those of the named files that are there, copied."""
    done = []
    for name in names:
        if matches(spark, f"{source}/{name}"):
            a, fs = _path(spark, f"{source}/{name}")
            b, to = _path(spark, f"{target}/{name}")
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, to, b, False, spark._jsc.hadoopConfiguration())
            done.append(name)
    return done


#: Tasks that shards are written by at most; the number is explicit, so that the few small rows of a shard aren't put together with others.
MOST_TASKS = 20_000
INDEX = "shard string, num_videos int, size_bytes long, sha256 string, first_task_id string, last_task_id string"


class _Hashed(io.RawIOBase):
    """A file that is hashed as it is written."""

    def __init__(self, raw) -> None:
        self.raw, self.digest, self.size = raw, hashlib.sha256(), 0

    def write(self, data) -> int:
        self.digest.update(data)
        self.size += len(data)
        self.raw.write(data)
        return len(data)

    def tell(self) -> int:
        return self.size

    def writable(self) -> bool:
        return True


def tar_shards(packed: DataFrame, folder: str, key: str = "task_id", path: str = "path", member: str = "videos/{}.mp4") -> DataFrame:
    """Writes uncompressed tar files ``shards/train-NNNNN.tar`` below a folder of any storage that Arrow knows, a task for each few, and returns their index.

    packed: ``shard_no``, the key and the path of each file. A shard is written beside its place under the attempt's name and renamed, so a task that is repeated
    replaces its own work. Members stand in order of the key."""
    root = folder.rstrip("/")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        system, shards_at = storage(f"{root}/shards")
        rows: list[tuple] = []
        current, archive, sink, part, first, last, n = None, None, None, "", None, None, 0

        def close() -> None:
            archive.close()
            sink.raw.close()
            system.move(part, part.rpartition(".tmp")[0])
            rows.append((f"shards/train-{current:05d}.tar", n, sink.size, sink.digest.hexdigest(), first, last))

        for b in batches:
            for number, k, at in zip(b.column("shard_no").to_pylist(), b.column("key").to_pylist(), b.column("path").to_pylist(), strict=True):
                if number != current:
                    if archive is not None:
                        close()
                    current, first, n = number, k, 0
                    part = f"{shards_at}/train-{number:05d}.tar.tmp{attempt}"
                    system.create_dir(shards_at, recursive=True)
                    sink = _Hashed(system.open_output_stream(part))
                    archive = tarfile.open(fileobj=sink, mode="w|", format=tarfile.PAX_FORMAT)
                with opened(at) as f:
                    info = tarfile.TarInfo(member.format(k))
                    info.size = f.size()
                    archive.addfile(info, f)
                last, n = k, n + 1
        if archive is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=["shard", "num_videos", "size_bytes", "sha256", "first_task_id", "last_task_id"])

    rows = packed.select("shard_no", F.col(key).alias("key"), F.col(path).alias("path"))
    shards = (packed.agg(F.max("shard_no")).first()[0] or 0) + 1
    return cut(rows.repartition(min(shards, MOST_TASKS), "shard_no").sortWithinPartitions("shard_no", "key").mapInArrow(write, INDEX))


def shard_index(spark: SparkSession, index: DataFrame, path: str) -> None:
    """The index as one JSON array in order of the shards."""
    write_text(spark, path, json.dumps([r.asDict() for r in index.orderBy("shard").collect()], ensure_ascii=False, indent=2) + "\n")


def located(metadata: DataFrame, packed: DataFrame, key: str = "task_id") -> DataFrame:
    """``metadata`` with file name and shard as they are after packing."""
    where = packed.select(key, F.concat(F.lit("videos/"), F.col(key), F.lit(".mp4")).alias("file_name"), shard_name(F.col("shard_no")).alias("shard"))
    return metadata.drop("file_name", "shard").join(where, key).select(*metadata.columns)
