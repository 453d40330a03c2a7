"""Reconciliation: what is on one side only, what differs, whether sets are equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Mismatch(ValueError):
    """Two sides that must have the same keys have not."""


def presence(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of both sides with ``in_left, in_right``: one shuffle answers every question of the kind. Null keys are equal to each other."""
    sides = left.select(*keys).withColumn("_l", F.lit(True)).unionByName(right.select(*keys).withColumn("_l", F.lit(False)))
    return sides.groupBy(*keys).agg(F.bool_or("_l").alias("in_left"), F.bool_or(~F.col("_l")).alias("in_right"))


def only_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of left whose key right has not; null keys have no partner."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def within(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")


def cardinalities(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``left_keys, right_keys, both, left_only, right_only``."""
    p = presence(left, right, keys)
    return p.agg(F.count_if("in_left").alias("left_keys"), F.count_if("in_right").alias("right_keys"), F.count_if(F.col("in_left") & F.col("in_right")).alias("both"), F.count_if(~F.col("in_right")).alias("left_only"), F.count_if(~F.col("in_left")).alias("right_only"))


def same_set(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``equal``: whether the sets of keys are the same. Two empty sets are."""
    return presence(left, right, keys).agg(F.coalesce(F.bool_and(F.col("in_left") & F.col("in_right")), F.lit(True)).alias("equal"))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], shown: int = 10) -> None:
    """Raises Mismatch naming some keys of one side only."""
    off = presence(left, right, keys).where("NOT (in_left AND in_right)")
    some = off.orderBy(*keys).limit(2 * shown).collect()
    if some:
        names = lambda side: [tuple(r[k] for k in keys) for r in some if r[side]][:shown]
        raise Mismatch(f"only left: {names('in_left')}; only right: {names('in_right')}")


def member_differences(left: DataFrame, right: DataFrame, group: str, member: str) -> DataFrame:
    """The members of one side only, a row each: ``group, member, finding`` (``missing``: the right side lacks it, ``extra``: the left side does). No group is gathered."""
    off = presence(left, right, [group, member]).where("NOT (in_left AND in_right)")
    return off.select(group, member, F.when(F.col("in_left"), F.lit("missing")).otherwise(F.lit("extra")).alias("finding"))


def value_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Keys on one side only or with values that differ (null equals null): ``keys, left_value, right_value``."""
    a = left.select(*keys, F.col(column).alias("left_value"), F.lit(True).alias("_l"))
    b = right.select(*keys, F.col(column).alias("right_value"), F.lit(True).alias("_r"))
    both = a.join(b, list(keys), "full_outer")
    return both.where(~F.col("left_value").eqNullSafe(F.col("right_value")) | F.col("_l").isNull() | F.col("_r").isNull()).select(*keys, "left_value", "right_value")


def refreshed(source: DataFrame, staged: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``source`` with ``columns`` taken from ``staged``; both must have the same keys and no blank in those columns (Mismatch)."""
    same_keys(source, staged, [key])
    blank = staged.where(" OR ".join(f"{c} IS NULL OR {c} = ''" for c in columns))
    names = [r[key] for r in blank.select(key).orderBy(key).limit(10).collect()]
    if names:
        raise Mismatch(f"blank {', '.join(columns)}: {names}")
    taken = source.drop(*columns).join(staged.select(key, *columns), key)
    return taken.select(*source.columns)
