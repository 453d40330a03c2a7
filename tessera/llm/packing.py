"""Filling containers of fixed capacity with items, neighbours together.

Items get a hashed vector of their text, projected to three dimensions and ordered along a Hilbert curve. The
curve is cut into ranges (range sort), each packed by one task: large items first take containers by best fit,
then the items along the curve fill them; where the next does not fit, the one of the next WINDOW that fits best does. The last
container of each range is all that may stay part empty; those are put together at the end.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut

#: Hashed dimensions, dimensions of the curve and bits of each.
HASHED, AXES, BITS = 64, 3, 10
#: Items looked at along the curve for one that fits, and the part of the capacity from which an item is large.
WINDOW, LARGE = 1024, 0.25
#: A range has about this many containers' worth of bytes at least; and pieces from the one to the other number.
RANGE_FILLS, RANGE_LEAST, RANGE_MOST = 64, 20_000, 1_000_000


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of points with whole coordinates below 2**bits (one row per point)."""
    x = axes.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level
        p = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(turned, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(texts: list[str | None]) -> np.ndarray:
    """Hilbert keys of texts: character trigrams hashed to HASHED counts, projected by fixed signs, scaled to the curve's grid."""
    known = [t or "" for t in texts]
    lengths = np.array([len(t) for t in known], np.int64)
    codes = np.frombuffer("".join(known).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    vectors = np.zeros((len(known), HASHED))
    if len(codes) >= 3:
        g = ((codes[:-2] << np.uint64(42)) ^ (codes[1:-1] << np.uint64(21)) ^ codes[2:]) * np.uint64(0x9E3779B97F4A7C15)
        owner = np.repeat(np.arange(len(known)), lengths)
        inside = owner[:-2] == owner[2:]
        cell = owner[:-2][inside] * HASHED + (g[inside] >> np.uint64(58)).astype(np.int64)
        vectors = np.bincount(cell, minlength=len(known) * HASHED).reshape(-1, HASHED).astype(float)
    signs = np.random.default_rng(11).choice([-1.0, 1.0], (HASHED, AXES))
    norm = np.sqrt(np.maximum((vectors**2).sum(1, keepdims=True), 1.0))
    place = np.tanh(vectors @ signs / norm)
    grid = np.clip(((place + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return hilbert(grid, BITS)


def pack(sizes: list[int], capacity: int, window: int = WINDOW) -> list[int]:
    """Container of each item (none above the capacity), items in the order of the curve."""
    place = [-1] * len(sizes)
    room: list[tuple[int, int]] = []  # (room left, container), ascending
    made = 0
    for i in sorted((i for i, s in enumerate(sizes) if s > LARGE * capacity), key=lambda i: (-sizes[i], i)):
        k = bisect_right(room, (sizes[i] - 1, 1 << 60))
        if k < len(room):
            left, c = room.pop(k)
        else:
            left, c, made = capacity, made, made + 1
        place[i] = c
        insort(room, (left - sizes[i], c))
    small = [i for i, s in enumerate(sizes) if s <= LARGE * capacity]
    opened = dict((c, left) for left, c in room)
    # containers in the order of the first large item along the curve
    order = list(dict.fromkeys(place[i] for i in range(len(sizes)) if place[i] >= 0))
    ahead: list[tuple[int, int]] = []  # (size, -place in small) of the items looked at, ascending
    taken = [False] * len(small)
    head = seen = turn = 0

    def look() -> None:
        nonlocal seen
        while seen < len(small) and len(ahead) < window:
            insort(ahead, (sizes[small[seen]], -seen))
            seen += 1

    look()
    while ahead:
        if turn < len(order):
            c = order[turn]
            left = opened[c]
        else:
            c, left, made = made, capacity, made + 1
        turn += 1
        while ahead:
            while taken[head]:
                head += 1
            size = sizes[small[head]]
            if left > 2 * size:
                k, pick = bisect_right(ahead, (size, -head)) - 1, head  # the next along the curve
            else:  # near the end: what fits best
                k = bisect_right(ahead, (left, 1)) - 1
                if k < 0:
                    break
                pick = -ahead[k][1]
                size = ahead[k][0]
            ahead.pop(k)
            taken[pick] = True
            place[small[pick]] = c
            left -= size
            look()
    return place


def _pack_range(capacity: int):
    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        held = pa.Table.from_batches(parts)
        sizes = held.column("bytes").to_pylist()
        place = pack(sizes, capacity)
        fills = np.bincount(place, sizes, max(place) + 1)
        # the emptiest goes last: it may be put together with those of other ranges
        rank = np.empty(len(fills), np.int64)
        rank[np.argsort(-fills, kind="stable")] = np.arange(len(fills))
        number = rank[np.array(place)]
        part = TaskContext.get().partitionId()
        out = held.append_column("part", pa.array(np.full(len(sizes), part, np.int32))).append_column("local", pa.array(number))
        yield from out.combine_chunks().to_batches()

    return packed


def filled(items: DataFrame, capacity: int) -> DataFrame:
    """``item, piece, bytes, shard`` for ``item STRING, bytes BIGINT, key BIGINT``: items in as few containers as possible, items of near keys together.

    An item above the capacity is divided into pieces of the capacity and a rest (``piece`` counts from 0); no other is. ``shard`` counts from
    0 without gaps. Items of no bytes take no room; ties and repeated rows are packed one by one. ``bytes`` must not be null or
    negative. An empty table gives an empty one. items is read several times: best a written table.
    """
    spark = items.sparkSession
    last = F.greatest(F.ceil(F.col("bytes") / F.lit(capacity)), F.lit(1)) - 1
    totals = items.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum(last + 1), F.lit(0)).alias("n")).first()
    ranges = max(1, min(totals["b"] // (RANGE_FILLS * capacity), totals["n"] // RANGE_LEAST), totals["n"] // RANGE_MOST)
    pieces = items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("bytes", F.least(F.col("bytes") - F.col("piece") * F.lit(capacity), F.lit(capacity)))
    ranged = pieces.repartitionByRange(int(ranges), "key", "item", "piece").sortWithinPartitions("key", "item", "piece")
    packed = cut(ranged.select("item", "piece", "bytes").mapInArrow(_pack_range(capacity), "item string, piece long, bytes long, part int, local long"))
    # per range: how many containers, and what the emptiest holds
    lasts = packed.groupBy("part").agg(F.max(F.struct("local")).alias("m")).select("part", F.col("m.local").alias("local"))
    ends = packed.join(F.broadcast(lasts), ["part", "local"]).groupBy("part", "local").agg(F.sum("bytes").alias("b")).orderBy("part").collect()  # one row per range
    room: list[tuple[int, int]] = []
    merged: dict[int, int] = {}
    offset = {}
    at = 0
    for r in ends:
        offset[r["part"]] = at
        at += r["local"]
    for r in sorted(ends, key=lambda r: (-r["b"], r["part"])):
        k = bisect_right(room, (r["b"] - 1, 1 << 60))
        left, shard = room.pop(k) if k < len(room) else (capacity, at)
        at += shard == at
        merged[r["part"]] = shard
        insort(room, (left - r["b"], shard))
    if not ends:
        return packed.select("item", "piece", "bytes", F.col("local").alias("shard"))
    where = F.broadcast(spark.createDataFrame([(r["part"], r["local"], offset[r["part"]], merged[r["part"]]) for r in ends], "part int, last long, offset long, merged long"))
    shard = F.when(F.col("local") == F.col("last"), F.col("merged")).otherwise(F.col("offset") + F.col("local"))
    return packed.join(where, "part").select("item", "piece", "bytes", shard.alias("shard"))


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = curve_keys(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("bytes"), pa.array(keys)], names=["item", "bytes", "key"])


def packed_files(files: DataFrame, item: str, size: str, text: str, limits: list[tuple[str, int]]) -> DataFrame:
    """``limit_name, <item>, piece, bytes, shard``: the files in shards, once for every capacity.

    Repeated rows of a file are one (its largest size and greatest text); a file whose size is null or negative in all of them comes out once per capacity
    with a null piece, size and shard; rows with a null item are left out; other columns are ignored.
    """
    own = files.where(F.col(item).isNotNull()).groupBy(F.col(item).alias("item")).agg(F.max(F.when(F.col(size) >= 0, F.col(size))).cast("bigint").alias("bytes"), F.max(text).alias("text"))
    keyed = cut(own.mapInArrow(_keyed, "item string, bytes long, key long"))
    known, unknown = keyed.where("bytes IS NOT NULL"), keyed.where("bytes IS NULL")
    out = None
    for name, capacity in limits:
        part = filled(known, capacity).unionByName(unknown.select("item", *[F.lit(None).cast("bigint").alias(c) for c in ("piece", "bytes", "shard")]))
        part = part.select(F.lit(name).alias("limit_name"), F.col("item").alias(item), "piece", "bytes", "shard")
        out = part if out is None else out.unionByName(part)
    return out
