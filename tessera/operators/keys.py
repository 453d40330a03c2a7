"""Operators on keyed tables: numbering, last wins, overlays, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """Keys that must be unique are not."""


def numbered(df: DataFrame, column: str = "ordinal") -> DataFrame:
    """``df`` with the place of each row, from 0 without gaps, in the order it is read: over all partitions, without bringing rows to one task.

    Only for plans that read the same rows in the same order again (files, checkpoints)."""
    part = df.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    counts = sorted(part.groupBy("_part").agg(F.count("*").alias("n"), F.min("_place").alias("first")).collect(), key=lambda r: r["_part"])  # one row per partition
    offsets, total = [], 0
    for r in counts:
        offsets.append((r["_part"], total - r["first"]))
        total += r["n"]
    if not offsets:
        return df.withColumn(column, F.lit(None).cast("bigint"))
    held = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _shift long"))
    return part.join(held, "_part").withColumn(column, F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")


def last_wins(df: DataFrame, keys: Sequence[str], *order: str | Column, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the last in ``order`` (null first); a row whose order ties is chosen by its values. Null keys are a key.

    The winner is aggregated, not sorted: what a hot key has many of is reduced before the shuffle. keep: the columns wanted beside the keys (all),
    so that no others are read."""
    rest = [c for c in (df.columns if keep is None else keep) if c not in keys]
    rank = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max(rank).alias("_top")).select(*[F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns if c in keys or c in rest])


def overlay(layers: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key, from the first layer that has the key. Layers have the same columns; a key repeated in a layer gives one of its rows, chosen by its values."""
    marked = None
    for i, layer in enumerate(layers):
        part = layer.withColumn("_layer", F.lit(-i))
        marked = part if marked is None else marked.unionByName(part)
    return last_wins(marked, keys, "_layer").drop("_layer")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys in several rows, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def unique(df: DataFrame, *keys: str, shown: int = 10) -> DataFrame:
    """``df`` if its keys are unique and not null, else DuplicateKeys naming some."""
    absent = df.where(" OR ".join(f"{k} IS NULL" for k in keys)).limit(1).count()
    found = duplicates(df, *keys).orderBy(*keys).limit(shown).collect()
    if absent or found:
        raise DuplicateKeys(", ".join(["null key"] * bool(absent) + [f"{tuple(r[k] for k in keys)} x{r['rows']}" for r in found]))
    return df
