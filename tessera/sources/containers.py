"""Binary sources: box headers of MP4 files, members of tar archives, measured values by an external probe, file digests.

Files are opened where they lie and only the bytes that are needed are read; paths go to the tasks, contents never
travel as rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import subprocess
import sys
import tarfile
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.functions import pandas_udf

from tessera.session import shuffle_partitions

#: Bytes of the head that the ``head`` mode walks, and of a chunk when a whole file is read.
HEAD, CHUNK = 4096, 8 << 20
BOXES = "array<struct<btype: string, offset: bigint, size: bigint>>"


def storage(path: str):
    """The file system of a path, of any storage that Arrow knows, and the path within it."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), path) if "://" not in path and not path.startswith("file:") else fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def opened(path: str):
    """A file with random access."""
    system, at = storage(path)
    return system.open_input_file(at)


#: Files after which a task says in its log how far it is.
PROGRESS = 250


def _counted(rows: Iterable, what: str) -> Iterator:
    """``rows``, telling the task's log after every PROGRESS of them."""
    for n, row in enumerate(rows, 1):
        yield row
        if n % PROGRESS == 0:
            print(f"{what} {n} files", file=sys.stderr, flush=True)


def boxes(f, size: int, limit: int | None = None) -> list[dict]:
    """Top-level boxes: type, offset, size. limit: only headers within the first bytes. A size of 0 reaches to the end, a size of 1 is in the next 8 bytes; a size that can't be ends the walk."""
    out, at = [], 0
    while at + 8 <= (size if limit is None else min(size, limit)):
        f.seek(at)
        head = f.read(16)
        length, kind = int.from_bytes(head[:4], "big"), head[4:8].decode("latin-1")
        out.append({"btype": kind, "offset": at, "size": length})
        if length == 1 and limit is None and len(head) == 16:
            length = int.from_bytes(head[8:16], "big")
            out[-1]["size"] = length
        if length < 8:
            break
        at += length
    return out


def _holds(f, what: bytes) -> bool:
    f.seek(0)
    tail = b""
    while part := f.read(CHUNK):
        if what in tail + part:
            return True
        tail = part[-len(what) + 1 :]
    return False


def spread(files: DataFrame) -> DataFrame:
    """Paths over many tasks, as each stands for much reading; the number is explicit, so small rows aren't put together again."""
    spark = files.sparkSession
    return files.repartition(max(shuffle_partitions(spark), 4 * spark.sparkContext.defaultParallelism))


def read_boxes(path: str, mode: str = "seek") -> list[dict]:
    """Boxes of one file; unreadable files have none. mode ``seek``: all top-level headers; ``head``: those in the first 4,096 bytes and, if ``moov`` is not among them, one of size -1 if its name occurs anywhere."""
    try:
        with opened(path) as f:
            size = f.size()
            found = boxes(f, size, HEAD if mode == "head" else None)
            if mode == "head" and all(b["btype"] != "moov" for b in found) and _holds(f, b"moov"):
                found.append({"btype": "moov", "offset": -1, "size": -1})
            return found
    except (OSError, ValueError):
        return []


def with_boxes(files: DataFrame, path: str = "path", mode: str = "seek") -> DataFrame:
    """``files`` with ``boxes``. A column of that name is replaced."""
    kept = files.drop("boxes")

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("btype", pa.string()), ("offset", pa.int64()), ("size", pa.int64())]))
        for b in batches:
            found = pa.array([read_boxes(p, mode) if p else [] for p in b.column(path).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, "boxes"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return spread(kept).mapInArrow(walk, f"{schema}, boxes {BOXES}")


def boxes_of(content, limit: int = HEAD):
    """Boxes of a binary column (small contents only), as an Arrow UDF."""
    @pandas_udf(BOXES)
    def walk(data: pd.Series) -> pd.Series:
        return data.map(lambda b: None if b is None else boxes(io.BytesIO(b), len(b), limit))

    return walk(content)


def digests(files: DataFrame, path: str = "path") -> DataFrame:
    """``files`` with ``sha256`` of each file, read in chunks; null if it can't be read. A column of that name is replaced."""
    kept = files.drop("sha256")

    def hashed(p: str | None) -> str | None:
        try:
            h = hashlib.sha256()
            with opened(p) as f:
                while part := f.read(CHUNK):
                    h.update(part)
            return h.hexdigest()
        except (OSError, ValueError, AttributeError, TypeError):
            return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(hashed, _counted(b.column(path).to_pylist(), "hashed")), pa.string())], names=[*b.schema.names, "sha256"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return spread(kept).mapInArrow(run, f"{schema}, sha256 string")


def ffprobe(path: str, binary: str = "ffprobe", timeout: int = 30) -> dict:
    """Width, height, frame rate, duration and frames of the first video stream by the external program; nothing if it is absent or fails."""
    wanted = "stream=width,height,avg_frame_rate,nb_frames,duration"
    try:
        done = subprocess.run([binary, "-v", "error", "-select_streams", "v:0", "-show_entries", wanted, "-of", "json", path], capture_output=True, timeout=timeout, check=True)
        stream = json.loads(done.stdout)["streams"][0]
    except (OSError, subprocess.SubprocessError, ValueError, LookupError):
        return {}
    return {"width": stream.get("width"), "height": stream.get("height"), "frame_rate": stream.get("avg_frame_rate"), "duration_seconds": stream.get("duration"), "num_frames": stream.get("nb_frames")}


def probed(files: DataFrame, probe: Callable[[str], dict] = ffprobe) -> DataFrame:
    """``task_id`` and what ``probe`` says of each ``path``, all as text; files it says nothing of are left out."""
    names = ("width", "height", "frame_rate", "duration_seconds", "num_frames")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, d) for i, p in _counted(zip(b.column("task_id").to_pylist(), b.column("path").to_pylist(), strict=True), "probed") if p and (d := probe(p.removeprefix("file:")))]
            text = lambda v: None if v is None else str(v)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.string()), *[pa.array([text(d.get(n)) for _, d in rows], pa.string()) for n in names]], names=["task_id", *names])

    return spread(files.select("task_id", "path")).mapInArrow(run, "task_id string, " + ", ".join(f"{n} string" for n in names))


class _Archive(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _TarReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self):
        return [_Archive(p) for p in self.paths]

    def read(self, partition):
        with opened(partition.path) as f, tarfile.open(fileobj=f, mode="r:") as archive:
            for m in archive:
                if m.isfile():
                    yield partition.path, m.name, m.size


class TarSource(DataSource):
    """``spark.read.format("tar").option("paths", <JSON array>)``: regular members of uncompressed archives, a partition each; ``archive, member, size``."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> str:
        return "archive string, member string, size bigint"

    def reader(self, schema) -> _TarReader:
        return _TarReader(json.loads(self.options["paths"]))


def tar_members(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "archive string, member string, size bigint")
    spark.dataSource.register(TarSource)
    return spark.read.format("tar").option("paths", json.dumps(paths)).load()


def integrity(files: DataFrame, floors: DataFrame, default_floor: int = 100_000) -> DataFrame:
    """``task_id, resolution, length, ok, issues`` for files with ``boxes``: missing or empty (then nothing else), smaller than the floor of the profile in the id, no ``ftyp`` or ``moov``, no ``mdat`` in a file above 200,000 bytes."""
    from tessera.functions.scalars import last_part

    lacks = lambda t: ~F.exists("boxes", lambda b: b["btype"] == t)
    empty = F.coalesce(F.col("length"), F.lit(0)) == 0
    held = files.withColumn("resolution", last_part(F.col("task_id"))).join(F.broadcast(floors.select("resolution", "min_bytes")), "resolution", "left")
    floor = F.coalesce("min_bytes", F.lit(default_floor))
    found = F.array_compact(F.array(F.when(F.col("length") < floor, "too small"), F.when(lacks("ftyp"), "no ftyp"), F.when(lacks("moov"), "no moov"), F.when(lacks("mdat") & (F.col("length") > 200_000), "no mdat")))
    issues = F.when(empty, F.array(F.lit("missing or empty"))).otherwise(found)
    return held.select("task_id", "resolution", "length", (F.size(issues) == 0).alias("ok"), issues.alias("issues"))
