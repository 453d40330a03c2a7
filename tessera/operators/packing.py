"""Next-fit packing in order, without one task seeing all rows.

Next-fit is a fold with a reset: a shard closes when the next item does not fit. What a range of rows does to the fold depends only on
the room that is left when it begins, and different beginnings soon come to the same shard starts. Each range of the order computes that function
once (prefix sums, binary search for the next start, pointer doubling); one task folds the ranges' functions, a few rows each; then every range numbers its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, shuffle_partitions


def _starts(sums: np.ndarray, capacity: int) -> np.ndarray:
    """For a shard starting at each row: where the next one starts (the number of rows if it ends the range)."""
    i = np.arange(len(sums) - 1)
    return np.maximum(i + 1, np.searchsorted(sums[1:], sums[:-1] + capacity, side="right"))


def _effect(sizes: np.ndarray, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """The range's function in pieces: from which room on, the fill it ends with, how many shards it starts. The room left never
    exceeds the capacity, so only the rows that one shard can reach begin a piece."""
    n = len(sizes)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    jump = np.append(_starts(sums, capacity), n)
    last, count = np.arange(n + 1), np.ones(n + 1, np.int64)
    count[n] = 0
    hop = jump.copy()
    while (hop[:n] < n).any():  # pointer doubling: the last start reached, and how many on the way
        inside = hop < n
        last = np.where(inside, last[np.minimum(hop, n - 1)], last)
        count = np.where(inside, count + count[hop], count)
        hop = hop[hop]
    fill = sums[n] - sums[last[:n]]
    # a row of no bytes never fails to fit once a shard is open, so none but the first begins a piece
    at = np.flatnonzero((sums[:n] <= capacity) & ((sums[:n] < sums[1:]) | (np.arange(n) == 0)))
    kept = np.ones(len(at), bool)
    kept[1:] = (fill[at[1:]] != fill[at[:-1]]) | (count[at[1:]] != count[at[:-1]])
    at = at[kept]
    return [-(2**62) if i == 0 else int(sums[i]) for i in at], fill[at].tolist(), count[:n][at].tolist()


def _functions(capacity: int):
    def functions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column("_size").to_numpy() for b in batches]
        sizes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if not len(sizes):
            return
        columns = _effect(sizes, capacity)
        part, total = TaskContext.get().partitionId(), int(sizes.sum())
        n = len(columns[0])
        yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([total] * n, pa.int64()), *[pa.array(c, pa.int64()) for c in columns]], names=["part", "total", "room", "fill", "starts"])

    return functions


def _fold(capacity: int):
    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill, shard = capacity + 1, -1  # nothing fits what isn't open: the first row starts shard 0
        part, after, out = None, (0, 0), []
        for b in batches:  # by part and room
            for p, total, room, ends, starts in zip(*(b.column(c).to_pylist() for c in ("part", "total", "room", "fill", "starts")), strict=True):
                if p != part:
                    if part is not None:
                        fill, shard = after
                    part, after = p, (fill + total, shard)
                    out.append((p, fill, shard))
                if room <= capacity - fill < total:  # the last such piece holds; none if all rows still fit
                    after = (ends, shard + starts)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["_part", "_fill", "_shard"])

    return fold


def _number(capacity: int, names: Sequence[str]):
    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        held = pa.Table.from_batches(parts)
        sizes = held.column("_size").to_numpy()
        fill, shard = held.column("_fill")[0].as_py(), held.column("_shard")[0].as_py()
        sums = np.concatenate([[0], np.cumsum(sizes)])
        jump = _starts(sums, capacity)
        at = int(np.searchsorted(sums[1:], capacity - fill, side="right"))
        begins = np.zeros(len(sizes), np.int64)
        while at < len(sizes):
            begins[at] = 1
            at = int(jump[at])
        out = held.select(list(names)).append_column("shard_no", pa.array(shard + np.cumsum(begins)))
        yield from out.combine_chunks().to_batches()

    return number


def next_fit(df: DataFrame, order: Sequence[str], size: str, capacity: int, ranges: int | None = None) -> DataFrame:
    """``df`` with ``shard_no BIGINT`` from 0: rows in ``order`` fill a shard until the next does not fit; a row above the capacity has a shard of its own.

    A null size counts as 0, a negative one too. Ties in ``order`` fall in the order of all columns' hash. A column named ``shard_no`` is replaced; an empty table stays empty.
    Columns whose names begin with an underscore and are used here (``_size, _tie, _part``) must not be among the others.
    """
    spark = df.sparkSession
    kept = df.drop("shard_no")
    n = ranges or shuffle_partitions(spark)
    sized = kept.withColumn("_size", F.greatest(F.coalesce(F.col(size), F.lit(0)).cast("bigint"), F.lit(0))).withColumn("_tie", F.xxhash64(*kept.columns))
    ranged = cut(sized.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").withColumn("_part", F.spark_partition_id()))
    functions = ranged.select("_size").mapInArrow(_functions(capacity), "part int, total long, room long, fill long, starts long")
    folded = cut(functions.repartition(1).sortWithinPartitions("part", "room").mapInArrow(_fold(capacity), "_part int, _fill long, _shard long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", shard_no long"
    return ranged.join(F.broadcast(folded), "_part").drop("_part", "_tie").mapInArrow(_number(capacity, kept.columns), schema)


def shard_summary(packed: DataFrame, key: str, size: str) -> DataFrame:
    """Per shard: ``shard_no, items, bytes, first_key, last_key``."""
    return packed.groupBy("shard_no").agg(F.count("*").alias("items"), F.sum(size).alias("bytes"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
