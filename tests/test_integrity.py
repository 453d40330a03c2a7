from datetime import datetime

from pyspark.sql import functions as F

from tessera.operators import orphans
from tessera.operators.differences import differences, digest_copy
from tessera.operators.orphans import orphan_references, state_references

T = datetime
REFS = "ref_field string, ref_key string, lookup string, at timestamp"
PARENTS = "ref_field string, lookup string, listed_at timestamp, removed_at timestamp, side string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_orphans_cases(spark):
    long = "x" * 5000
    parents = spark.createDataFrame(
        [
            ("f", "gone", T(2024, 1, 1), T(2024, 2, 1), "clash"),
            ("f", "back", T(2024, 1, 1), T(2024, 2, 1), "clash"),
            ("f", "back", T(2024, 3, 5), None, "clash"),
            ("f", "ok", None, None, "clash"),
            ("f", long, T(2024, 1, 1), None, "clash"),
            ("f", None, T(2024, 1, 1), None, "clash"),
        ],
        PARENTS,
    )
    at = T(2024, 3, 1)
    refs = spark.createDataFrame(
        [("f", k, k, at) for k in ("gone", "back", "ok", "none", "none", long, long + "y", "")] + [("g", "ok", "ok", at), ("f", "n", None, at), ("f", "back", "back", None), ("f", "back", "back", T(2024, 3, 9))],
        REFS,
    )
    got = rows(orphan_references(refs, parents, 3))
    assert got == sorted([("f", "gone", "deleted", "2024-03"), ("f", "back", "late", "2024-03"), ("f", "none", "missing", "2024-03"), ("f", long + "y", "missing", "2024-03"), ("f", "", "missing", "2024-03"), ("g", "ok", "missing", "2024-03"), ("f", "n", "missing", "2024-03")])


def test_orphans_empty(spark):
    refs, parents = spark.createDataFrame([], REFS), spark.createDataFrame([], PARENTS)
    assert rows(orphan_references(refs, parents, 2)) == []
    assert rows(orphan_references(spark.createDataFrame([("f", "a", "a", T(2024, 1, 1))], REFS), parents, 2)) == [("f", "a", "missing", "2024-01")]


def test_orphans_hot_key(spark):
    refs = spark.range(20000).selectExpr("'f' ref_field", "if(id % 3 = 0, 'hot', concat('k', id)) ref_key", "if(id % 3 = 0, 'hot', concat('k', id)) lookup", "timestamp'2024-01-01' at")
    parents = spark.range(0, 20000, 2).selectExpr("'f' ref_field", "concat('k', id) lookup", "timestamp'2023-01-01' listed_at", "cast(null as timestamp) removed_at")
    assert orphan_references(refs, parents, 4).count() == 1 + sum(1 for i in range(20000) if i % 3 and i % 2)


def test_state_references(spark):
    state = spark.createDataFrame(
        [("", "s1", "done", " C:\\x\\A.MP4 ", T(2024, 1, 1)), ("t2", "s2", "done", "  ", T(2024, 1, 1)), (None, "s3", "failed", "o/b.mp4", T(2024, 1, 1))],
        "task_id string, file_stem string, status string, output_path string, loaded_at timestamp",
    )
    assert rows(state_references(state).select("ref_field", "ref_key", "lookup")) == [("state.output_path", "s1", "a.mp4"), ("state.task_id", "s1", "s1"), ("state.task_id", "s3", "s3"), ("state.task_id", "t2", "t2")]


def test_differences_cases(spark):
    side = "k string, a string, b int, n int, _bucket int"
    left = spark.createDataFrame([("1", "x", 1, 0, 9), ("1", "x", 1, 0, 9), ("2", None, 2, 0, 9), ("3", "z", 3, 0, 9), ("5", "e", None, 0, 9), (None, "q", 1, 0, 9)], side)
    right = spark.createDataFrame([("1", "old", 7, 1, 9), ("1", "x", 1, 2, 9), ("2", "", 2, 1, 9), ("4", "z", 3, 1, 9), ("5", "f", 5, 1, 9)], side)
    got = rows(differences(left, right, "k", ["a", "b"], right_order="n"))
    assert got == [("2", "a"), ("3", "only_left"), ("4", "only_right"), ("5", "a"), ("5", "b")]
    assert rows(differences(left, left, "k", ["a", "b"])) == []
    assert rows(differences(left.limit(0), left.limit(0), "k", ["a", "b"])) == []
    assert len(rows(differences(left, right.limit(0), "k", ["a", "b"]))) == 4


def test_digest_copy(spark):
    df = spark.createDataFrame([("*videos\\A.mp4\r", " AB "), ("./videos/A.mp4", "ab"), ("videos/A.mp4 ", None), (None, "x"), ("", "x")], "file_name string, sha256 string")
    assert rows(digest_copy(df).where("task_id is not null")) == [("videos/A.mp4", "", "A"), ("videos/A.mp4", "ab", "A"), ("videos/A.mp4", "ab", "A")]
    assert digest_copy(df).where("task_id is null").count() == 2


def test_differences_hot_key_and_long_values(spark):
    hot = spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) k", "if(id % 3 = 0, concat('v', id), 'same') a", "id n")
    long = spark.createDataFrame([("long", "x" * 100_000, 1), ("", "e", 1)], "k string, a string, n long")
    left, right = hot.unionByName(long), hot.where("k <> 'k1'").unionByName(long.withColumn("a", F.concat("a", "k")))
    got = rows(differences(left, right, "k", ["a"], "l", "r", "n", "n"))
    assert got == [("k1", "only_l"), ("long", "a")]


def test_hot_lookup_is_spread(spark):
    """One path in a third of the reports: its references go over several ranges and all find their parent."""
    at = "timestamp'2026-01-05 00:00:00'"
    refs = spark.range(30_000).selectExpr("'f' ref_field", "concat('r', id) ref_key", "case when id % 3 = 0 then 'hot.mp4' when id % 3 = 1 then 'gone.mp4' else concat('p', id) end lookup", f"{at} at")
    parents = spark.sql(f"select 'f' ref_field, 'hot.mp4' lookup, {at} listed_at, cast(null as timestamp) removed_at union all select 'f', 'gone.mp4', {at}, {at}")
    found = orphan_references(refs, parents, 8)
    by = {r["finding"]: r["count"] for r in found.groupBy("finding").count().collect()}
    assert by == {"deleted": 10_000, "missing": 10_000}
    hot = orphans._spread(refs, 8).collect()
    assert len(hot) == 2 and all(4 <= r["_copies"] <= 8 for r in hot)
    assert orphans._spread(refs.limit(0), 8).count() == 0
