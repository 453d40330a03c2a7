"""Differences between two copies of data by a column-by-bucket checksum matrix.

Rows are hashed where they are read. Keys fall into buckets; per bucket and column the hashes are added up
(addition commutes, so neither order nor place matters). Only buckets and columns whose sums differ are
read again and joined. As a key may be in several rows, of which one counts, each row's key and hashes move once, to settle that; values move only
in unequal buckets and columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut

#: Keys per bucket aimed at: fewer make the matrix larger, more make a difference read more equal rows again.
KEYS_PER_BUCKET = 4
LOW = 0xFFFFFFFF
#: Unequal buckets (of 12 bytes) that are broadcast at most; more are met by a join that sorts both sides.
BROADCAST = 2_000_000


def _halves(*values: Column) -> list[Column]:
    """128 bits of hash as two numbers: the same values hashed from two beginnings."""
    return [F.xxhash64(F.lit("a"), *values), F.xxhash64(F.lit("b"), *values)]


def _wide(a: Column, b: Column) -> list[Column]:
    """128 bits of hash as four numbers of 32 bits, so that 2**31 rows of a bucket add up without overflow."""
    return [a.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(a, 32), b.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(b, 32)]


def _current(df: DataFrame, key: str, columns: Sequence[str], order: str | None, carried: Sequence[str]) -> DataFrame:
    """One row per key, the one with the highest ``order``, ties by the highest hashes: the hashes of ``columns``
    as ``_h<i>a, _h<i>b``, and the values of ``carried``. Hashes alone leave the task where nothing is carried."""
    names = [f"_h{i}{half}" for i in range(len(columns)) for half in "ab"]
    hashes = [h.alias(n) for n, h in zip(names, [h for c in columns for h in _halves(F.lit(c), F.col(key), F.col(c))], strict=True)]
    rank = [F.col(order).alias("_order")] if order else []
    row = F.struct(*rank, *hashes, *[F.col(c) for c in carried])
    top = df.where(F.col(key).isNotNull()).groupBy("_bucket", key).agg(F.max(row).alias("_top"))
    return top.select("_bucket", key, *[F.col(f"_top.{n}") for n in names], *[F.col(f"_top.{c}").alias(c) for c in carried])


def differences(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    left_name: str = "left",
    right_name: str = "right",
    left_order: str | None = None,
    right_order: str | None = None,
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> DataFrame:
    """``key, finding``: keys on one side only (``only_<name>``) and, field by field, keys whose values differ (``<column>``).

    Rows with a null key are left out. Of several rows of a key the one with the highest ``*_order`` counts,
    then one chosen by the hashes of its values; equal repeats count once. Null equals null and differs from
    any value. Other columns, whatever their names, are ignored. Two empty sides give no rows.
    """
    names = list(columns)
    n = max(left.count(), right.count())  # Parquet answers from its footers
    buckets = 1 << max(10, (max(1, n // keys_per_bucket) - 1).bit_length())
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit("bucket")), F.lit(buckets)).alias("_bucket")

    def side(df: DataFrame, order: str | None) -> DataFrame:
        return df.select(bucket, key, *names, *([order] if order and order not in names else []))

    sides = ((side(left, left_order), left_order, 1), (side(right, right_order), right_order, -1))
    width = 4
    cells = [f"_{c}_{k}" for c in range(len(names) + 1) for k in range(width)]

    def sums(df: DataFrame, order: str | None, sign: int) -> DataFrame:
        hashes = [_wide(*_halves(F.col(key))), *[_wide(F.col(f"_h{i}a"), F.col(f"_h{i}b")) for i in range(len(names))]]
        flat = [(h * sign).alias(cells[i * width + k]) for i, hs in enumerate(hashes) for k, h in enumerate(hs)]
        return _current(df, key, names, order, []).select("_bucket", *flat)

    both = sums(*sides[0]).unionByName(sums(*sides[1]))
    matrix = both.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in cells])
    unequal = lambda i: F.greatest(*[(F.col(cells[i * width + k]) != 0).cast("int") for k in range(width)]) == 1
    flags = [unequal(0).alias("_keys"), *[unequal(i + 1).alias(f"_differs_{i}") for i in range(len(names))]]
    located = cut(matrix.select("_bucket", *flags).where(" OR ".join(["_keys", *[f"_differs_{i}" for i in range(len(names))]])))
    count, *seen = located.agg(F.count("*"), *[F.max(f"_differs_{i}") for i in range(len(names))]).first()
    buckets_only = located.select("_bucket")
    met = F.broadcast(buckets_only) if count <= BROADCAST else buckets_only
    differing = [c for c, any_bucket in zip(names, seen, strict=True) if any_bucket]

    def again(df: DataFrame, order: str | None) -> DataFrame:
        part = df.join(met, "_bucket", "left_semi")
        current = _current(part, key, names, order, differing)
        return current.select(key, *[F.col(c) for c in differing], F.lit(True).alias("_here"))

    a, b = again(*sides[0][:2]).alias("a"), again(*sides[1][:2]).alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    here = lambda s: F.col(f"{s}._here").isNotNull()
    found = F.when(~here("b"), F.array(F.lit(f"only_{left_name}"))).when(~here("a"), F.array(F.lit(f"only_{right_name}")))
    fields = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in differing]
    found = found.otherwise(F.array_compact(F.array(*fields)) if fields else F.array().cast("array<string>"))
    return joined.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), F.explode(found).alias("finding"))


_EDGES = r"^[\s 　﻿]+|[\s 　﻿]+$"


def plain_path(path: Column) -> Column:
    """A file name in one spelling: no blanks or line ends around it, no leading ``*`` or ``./``, slashes only."""
    slashes = F.translate(F.regexp_replace(path, _EDGES, ""), "\\", "/")
    return F.regexp_replace(slashes, r"^(?:\*\s*)?(?:\./+)*", "")


def stem(path: Column) -> Column:
    """The last part of a path in one spelling, without its ending; empty gives null."""
    return F.nullif(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", ""), F.lit(""))


def plain_digest(digest: Column) -> Column:
    """A digest in lower case without blanks around it; null equals blank."""
    return F.coalesce(F.lower(F.regexp_replace(digest, _EDGES, "")), F.lit(""))


def digest_copy(df: DataFrame, order: str | None = None) -> DataFrame:
    """``task_id, file_name, sha256`` of a table that says which file has which digest."""
    name = plain_path(F.col("file_name"))
    return df.select(name.alias("file_name"), plain_digest(F.col("sha256")).alias("sha256"), *([order] if order else [])).withColumn("task_id", stem(F.col("file_name")))
