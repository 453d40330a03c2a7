"""Counts and distributions: reports are aggregates over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import percent, whole_mean


def matrix(df: DataFrame, row: str, column: str, values: Sequence[str], other: str | None = None) -> DataFrame:
    """Counts per ``row``, a column for each of ``values`` and ``total``; other: a column for all else."""
    of = [F.count_if(F.col(column) == v).alias(v) for v in values]
    rest = [F.count_if(~F.coalesce(F.col(column).isin(*values), F.lit(False))).alias(other)] if other else []
    return df.groupBy(row).agg(*of, *rest, F.count("*").alias("total"))


def nested_counts(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """``outer, counts``: a map from each value of ``inner`` to its rows. Null becomes ``?``."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c)
    pairs = df.select(known(outer), known(inner)).groupBy(outer, inner).agg(F.count("*").alias("n"))
    return pairs.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(inner, "n")))).alias("counts"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, rows`` without nulls."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


#: Sizes of a bin of the first pass of the median: 2**20 bytes, so neither pass orders more than some million values of a group.
BIN = 1 << 20


def size_distribution(df: DataFrame, group: str, size: str) -> DataFrame:
    """Per group ``files, mean_bytes`` (rounded down)``, median_bytes`` (the upper one)``, least_bytes, most_bytes``; null sizes are left out, a null group is one.

    The median is exact: counts per bin tell the bin that holds it, counts per size within that bin tell the size; whole groups are never sorted or gathered."""
    known = df.where(F.col(size).isNotNull()).select(F.col(group).alias("_g"), F.col(size).cast("bigint").alias("_s")).withColumn("_b", F.floor(F.col("_s") / BIN).cast("bigint"))
    bins = known.groupBy("_g", "_b").agg(F.count("*").alias("n"), F.sum("_s").alias("total"), F.min("_s").alias("least"), F.max("_s").alias("most"))
    sums = bins.groupBy("_g").agg(F.sum("n").alias("files"), F.sum("total").alias("total"), F.min("least").alias("least_bytes"), F.max("most").alias("most_bytes"))
    upto = lambda order: F.sum("n").over(Window.partitionBy("_g").orderBy(order))
    place = F.floor(F.col("files") / 2)  # counted from 0
    middle = bins.withColumn("upto", upto("_b")).alias("x").join(sums.alias("y"), F.col("x._g").eqNullSafe(F.col("y._g"))).where((F.col("upto") > place) & (F.col("upto") - F.col("n") <= place))
    middle = middle.select(F.col("x._g").alias("_g"), "_b", (place - (F.col("upto") - F.col("n"))).alias("left"), "files", F.col("y.total").alias("total"), "least_bytes", "most_bytes")
    fine = known.alias("k").join(middle.alias("m"), F.col("k._g").eqNullSafe(F.col("m._g")) & (F.col("k._b") == F.col("m._b"))).groupBy("m._g", "_s", "left", "files", "total", "least_bytes", "most_bytes").agg(F.count("*").alias("n"))
    found = fine.withColumn("upto", upto("_s")).where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("n") <= F.col("left")))
    return found.select(F.col("_g").alias(group), "files", whole_mean(F.col("total"), F.col("files")).alias("mean_bytes"), F.col("_s").alias("median_bytes"), "least_bytes", "most_bytes")


def status_counts(states: DataFrame) -> DataFrame:
    return states.groupBy(F.coalesce("status", F.lit("?")).alias("status")).agg(F.count("*").alias("reports"))


def progress(states: DataFrame, expected: DataFrame, done: str = "done") -> DataFrame:
    """One row: ``expected`` keys (of reports, where nothing is expected), ``done, touched, untouched, percent_done``. Both sides have a unique ``task_id``."""
    touched = states.agg(F.count("*").alias("touched"), F.count_if(F.col("status") == done).alias("done"))
    total = expected.agg(F.count("*").alias("planned"))
    both = touched.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")  # one row each
    whole = F.when(F.col("planned") > 0, F.col("planned")).otherwise(F.col("touched"))
    return both.select(whole.alias("expected"), "done", "touched", F.greatest(F.lit(0), F.col("planned") - F.col("touched")).alias("untouched"), percent(F.col("done"), whole).alias("percent_done"))


def group_variants(df: DataFrame, group: str, key: str, variant: str, firsts: Sequence[str]) -> DataFrame:
    """Per group (null left out) the columns ``firsts`` of its lowest key, its keys and distinct variants in order, and their number."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.min_by(c, key).alias(c) for c in firsts], F.array_sort(F.collect_set(key)).alias("keys"), F.array_sort(F.collect_set(variant)).alias("variants"), F.count_distinct(variant).alias("variant_count")
    )
