"""References to records that do not exist, are deleted or arrive later.

Both sides are first reduced (map-side combined) to one row per key, references to one per key, what they look up and period, then
range-partitioned together. Within a range the parents come first, as one sorted array; batches of references are probed by binary search.
What very many different keys look up (one path in a third of the reports) is spread over several ranges, each with a copy of its parent row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, shuffle_partitions

#: Buckets that lookups are counted in to find frequent ones, and references of a bucket that are never spread.
BUCKETS, FEW = 1 << 17, 1024
#: Keys longer than this many characters are compared by digest, which bounds the width of the arrays.
WIDE_KEY = 64


def _fixed(key: Column) -> Column:
    """A key of bounded width that is equal exactly where ``key`` is; long keys and ones with NUL become digests."""
    plain = (F.octet_length(key) <= WIDE_KEY) & ~F.contains(key, F.lit("\0")) & ~F.startswith(key, F.lit("#"))
    return F.when(plain, key).otherwise(F.concat(F.lit("#"), F.sha2(key, 256)))


def path_leaf(path: Column) -> Column:
    """The last part of a path: slash or backslash, surrounding blanks and letter case ignored; blank gives null."""
    trimmed = F.regexp_replace(path, r"^[\s 　]+|[\s 　]+$", "")
    leaf = F.element_at(F.split(F.translate(trimmed, "\\", "/"), "/"), -1)
    return F.nullif(F.lower(F.trim(leaf)), F.lit(""))


def month(at: Column) -> Column:
    """``yyyy-MM`` of a timestamp, whatever the session's zone."""
    return F.substring(at.cast("string"), 1, 7)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys: list[np.ndarray] = []
    live: list[np.ndarray] = []
    first: list[np.ndarray] = []
    parents: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        side = batch.column("side").to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(side, 1))  # rows are sorted by side: parents, then references
        fixed = np.array([k.encode() for k in batch.column("fixed").to_pylist()], dtype=bytes)
        at = batch.column("at").fill_null(np.iinfo(np.int64).max).to_numpy()
        if cut:
            keys.append(fixed[:cut])
            live.append(batch.column("live").to_numpy(zero_copy_only=False)[:cut])
            first.append(at[:cut])
        if cut == len(side):
            continue
        if parents is None:
            parents = tuple(np.concatenate(x) if x else np.array([], t) for x, t in ((keys, "S1"), (live, "i8"), (first, "i8")))
        held, alive, since = parents
        probe, when = fixed[cut:], at[cut:]
        found = np.zeros(len(probe), bool)
        place = np.zeros(len(probe), np.int64)
        if len(held):
            place = np.minimum(np.searchsorted(held, probe), len(held) - 1)
            found = held[place] == probe
        gone = found & ((alive[place] == 0) if len(held) else False)
        late = found & ~gone & ((since[place] > when) if len(held) else False)
        code = np.where(~found, 1, np.where(gone, 2, np.where(late, 3, 0)))
        hit = np.flatnonzero(code)
        if len(hit):
            rows = pa.array(hit + cut)
            names = pa.array(["missing", "deleted", "late"]).take(pa.array(code[hit] - 1))
            yield pa.RecordBatch.from_arrays([batch.column("ref_field").take(rows), batch.column("ref_key").take(rows), names, batch.column("period").take(rows)], names=["ref_field", "ref_key", "finding", "period"])


def _spread(refs: DataFrame, ranges: int) -> DataFrame:
    """``_bucket, _copies``: the buckets of lookups with more than half a range's share of all references, and how many ranges each goes over: at most twice ``ranges`` rows, whatever the data."""
    counts = refs.where("lookup IS NOT NULL").groupBy(_bucket().alias("_bucket")).agg(F.count("*").alias("n"))
    counts = cut(counts)  # at most BUCKETS rows
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(FEW, total // (2 * ranges) + 1)
    return counts.where(F.col("n") > share).select("_bucket", F.ceil(F.col("n") / share).cast("int").alias("_copies"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("ref_field", "lookup"), F.lit(BUCKETS)).cast("int")


def orphan_references(refs: DataFrame, parents: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per distinct reference that finds no usable parent.

    refs: ``ref_field STRING`` (the referring field), ``ref_key STRING`` (what is reported), ``lookup STRING``
    (what is looked up), ``at TIMESTAMP``. parents: ``ref_field`` (which field refers to it), ``lookup``,
    ``listed_at TIMESTAMP``, ``removed_at TIMESTAMP`` (set: deleted). Other columns are ignored.

    Result ``ref_field, ref_key, finding, period``; ``period`` is the month of ``at``; ``finding`` is
    ``missing`` (no parent row), ``deleted`` (all parent rows have ``removed_at``) or ``late`` (the earliest
    ``listed_at`` of the rows not deleted is after ``at``). A null ``lookup`` refers to nothing: ``missing``.
    A null ``at`` has a null period and is never late; a parent row with a null ``listed_at`` is there from the start;
    repeated rows count once; empty tables give no rows or only ``missing`` ones.
    """
    spark = refs.sparkSession
    n = partitions or shuffle_partitions(spark)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    wanted = (
        refs.select("ref_field", "ref_key", "lookup", month(F.col("at")).alias("period"), micros(F.col("at")).alias("at"))
        .groupBy("ref_field", "ref_key", "lookup", "period")
        .agg(F.min("at").alias("at"))
    )
    nothing = wanted.where("lookup IS NULL").select("ref_field", "ref_key", F.lit("missing").alias("finding"), "period")
    kept = F.col("removed_at").isNull()
    held = (
        parents.where("lookup IS NOT NULL")
        .groupBy("ref_field", "lookup")
        .agg(F.count_if(kept).alias("live"), F.min(F.when(kept, F.coalesce(micros(F.col("listed_at")), F.lit(-(2**62))))).alias("at"))
    )
    # bounded: at most 2 n rows
    hot = F.broadcast(_spread(refs, n))
    copies = F.coalesce("_copies", F.lit(1))
    placed = lambda df: df.withColumn("_bucket", _bucket()).join(hot, "_bucket", "left")
    held = placed(held).withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    wanted = placed(wanted.where("lookup IS NOT NULL")).withColumn("copy", F.pmod(F.xxhash64("ref_key", "period"), copies).cast("int"))
    tagged = held.select(
        F.lit(0).alias("side"), "ref_field", "lookup", "copy", F.lit(None).cast("string").alias("ref_key"), F.lit(None).cast("string").alias("period"), "at", "live"
    ).unionByName(wanted.select(F.lit(1).alias("side"), "ref_field", "lookup", "copy", "ref_key", "period", "at", F.lit(0).cast("bigint").alias("live")))
    ranged = (
        tagged.withColumn("fixed", F.concat("ref_field", F.lit("|"), _fixed(F.col("lookup"))))
        .drop("lookup")
        .repartitionByRange(n, "fixed", "copy")
        .sortWithinPartitions("side", "fixed")
    )
    misses = ranged.mapInArrow(_probe, "ref_field string, ref_key string, finding string, period string")
    return misses.unionByName(nothing).distinct()


def state_references(state: DataFrame) -> DataFrame:
    """The references of run reports: their task, and the file of finished ones with a path."""
    key = F.coalesce(F.nullif(F.col("task_id"), F.lit("")), F.col("file_stem"))
    leaf = path_leaf(F.col("output_path"))
    both = F.array(
        F.struct(F.lit("state.task_id").alias("ref_field"), key.alias("lookup")),
        F.when((F.col("status") == "done") & leaf.isNotNull(), F.struct(F.lit("state.output_path").alias("ref_field"), leaf.alias("lookup"))),
    )
    return (
        state.select(key.alias("ref_key"), F.col("loaded_at").alias("at"), F.explode(both).alias("r"))
        .where("r IS NOT NULL")
        .select("r.ref_field", "ref_key", "r.lookup", "at")
    )


def state_parents(tasks: DataFrame, media: DataFrame) -> DataFrame:
    """What run reports refer to: tasks by id, files by the last part of their path."""
    return tasks.select(F.lit("state.task_id").alias("ref_field"), F.col("task_id").alias("lookup"), F.col("loaded_at").alias("listed_at"), F.col("withdrawn_at").alias("removed_at")).unionByName(
        media.select(F.lit("state.output_path").alias("ref_field"), path_leaf(F.col("path")).alias("lookup"), "listed_at", "removed_at")
    )
