"""Validation rules: each gives its violations as ``rule_id, severity, subject, detail``; none stops at the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.reconcile import presence, value_differences

ERROR, WARN = "error", "warn"


def violations(df: DataFrame, rule: str, subject: Column, detail: Column | str, severity: str = ERROR) -> DataFrame:
    said = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"), said.cast("string").alias("detail"))


def row_count(df: DataFrame, rule: str, expected: int, what: str = "rows") -> DataFrame:
    """The number of rows must be as expected."""
    return violations(df.agg(F.count("*").alias("n")).where(F.col("n") != expected), rule, F.lit(what), F.concat(F.col("n").cast("string"), F.lit(f", expected {expected}")))


def unique_key(df: DataFrame, rule: str, key: str) -> DataFrame:
    found = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return violations(found, rule, F.col(key), F.concat(F.lit("rows: "), F.col("n").cast("string")))


def group_shape(df: DataFrame, rule: str, group: str, groups: int | None, rows: int) -> DataFrame:
    """Every group must have so many rows and, if given, there must be so many groups. Rows without a group are left out."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    off = violations(sizes.where(F.col("n") != rows), rule, F.col(group), F.concat(F.lit("rows: "), F.col("n").cast("string"), F.lit(f", expected {rows}")))
    return off if groups is None else off.unionByName(row_count(sizes, rule, groups, "groups"))


def key_domain(df: DataFrame, rule: str, key: str, domain: Sequence, rows: int | None = None) -> DataFrame:
    """The values must be those of the domain and, if given, each in so many rows; a value of the domain without rows counts 0."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    known = spark.createDataFrame([(v, True) for v in domain], f"{key} {kind}, known boolean")
    counted = df.groupBy(key).agg(F.count("*").alias("n")).join(known, key, "full_outer")
    n = F.coalesce("n", F.lit(0))
    off = counted.where(F.col("known").isNull() | (n == 0) | ((n != rows) if rows is not None else F.lit(False)))
    return violations(off, rule, F.coalesce(F.col(key).cast("string"), F.lit("null")), F.when(F.col("known").isNull(), F.lit("not in the domain")).otherwise(F.concat(F.lit("rows: "), n.cast("string"))))


def matches_lookup(df: DataFrame, rule: str, key: str, lookup: DataFrame, on: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Columns must equal those that the lookup has for the row; unknown, missing and blank values are violations too. pairs: (column, column of the lookup)."""
    held = lookup.select(F.col(on), *[F.col(b).alias(f"_want{i}") for i, (_, b) in enumerate(pairs)], F.lit(True).alias("_known"))
    joined = df.join(F.broadcast(held), on, "left")
    off = F.array_compact(F.array(*[F.when(~F.col(a).eqNullSafe(F.col(f"_want{i}")), F.lit(a)) for i, (a, _) in enumerate(pairs)]))
    found = F.when(F.col("_known").isNull(), F.lit(f"unknown {on}")).otherwise(F.array_join(off, ","))
    return violations(joined.withColumn("_off", found).where("_off <> ''"), rule, F.col(key), F.col("_off"))


def all_equal(df: DataFrame, rule: str, key: str, column: str, value: str) -> DataFrame:
    off = df.where(~F.col(column).eqNullSafe(F.lit(value)))
    return violations(off, rule, F.col(key), F.concat(F.lit(f"{column}: "), F.coalesce(F.col(column), F.lit("null"))))


def same_keys(left: DataFrame, right: DataFrame, rule: str, key: str, severities: tuple[str, str] = (ERROR, ERROR), names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Keys on one side only; severities: of those only left and only right."""
    off = presence(left, right, [key]).where("NOT (in_left AND in_right)")
    severity = F.when(F.col("in_left"), F.lit(severities[0])).otherwise(F.lit(severities[1]))
    said = F.when(F.col("in_left"), F.lit(f"only in {names[0]}")).otherwise(F.lit(f"only in {names[1]}"))
    return off.select(F.lit(rule).alias("rule_id"), severity.alias("severity"), F.col(key).cast("string").alias("subject"), said.alias("detail"))


def same_values(left: DataFrame, right: DataFrame, rule: str, key: str, column: str) -> DataFrame:
    off = value_differences(left, right, [key], column)
    return violations(off, rule, F.col(key), F.concat(F.coalesce("left_value", F.lit("null")), F.lit(" / "), F.coalesce("right_value", F.lit("null"))))


def not_blank(df: DataFrame, rule: str, key: str, columns: Sequence[str]) -> DataFrame:
    off = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in columns]))
    return violations(df.withColumn("_off", F.array_join(off, ",")).where("_off <> ''"), rule, F.col(key), F.concat(F.lit("blank "), F.col("_off")))


def together(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verdict(found: DataFrame) -> DataFrame:
    """One row ``ok, errors, warnings``; warnings do not fail."""
    return found.agg((F.count_if(F.col("severity") == ERROR) == 0).alias("ok"), F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARN).alias("warnings"))


def samples(found: DataFrame, shown: int = 20) -> DataFrame:
    """Per rule its number of violations and the first few subjects: for display only. The few are ranked before they are gathered, so no list grows with the data."""
    counts = found.groupBy("rule_id", "severity").agg(F.count("*").alias("violations"))
    ranked = found.select("rule_id", "severity", "subject").distinct().withColumn("_r", F.row_number().over(Window.partitionBy("rule_id", "severity").orderBy("subject")))
    few = ranked.where(F.col("_r") <= shown).groupBy("rule_id", "severity").agg(F.array_sort(F.collect_list("subject")).alias("subjects"))
    return counts.join(few, ["rule_id", "severity"], "left")
