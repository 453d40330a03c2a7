import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars, text
from tessera.operators import keys, reconcile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


TOKENS = ["RAW", "8K", "4K ", "film look", "aRA", "a", ""]


def python_clean(s, tokens):
    import re

    for t in tokens:
        if t:
            s = s.replace(t, "")
    s = re.sub(" {2,}", " ", re.sub(",(?: ,)+", ",", re.sub(",{2,}", ",", s)))
    return s.strip(text.EDGE)


def test_clean(spark):
    import random

    random.seed(1)
    parts = [*TOKENS, ",", ", ,", ",,", " ", "  ", "，", ".", "R", "AW", "x", "K"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(800)] + ["", "RAW"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = df.select("t", text.clean(F.col("t"), TOKENS).alias("c"), text.remove_tokens(F.col("t"), TOKENS).alias("r"), text.remove_tokens_bulk(TOKENS)(F.col("t")).alias("b")).collect()
    for r in got:
        assert r["r"] == r["b"]
        assert r["c"] == (None if r["t"] is None else python_clean(r["t"], TOKENS))
    assert text.shadowed_tokens(["8K", "RED 8K", "x"]) == [("RED 8K", "8K")]
    e = df.where("t = 'RAW'").select(text.enhance(F.col("t"), TOKENS, "<", ">", "no")).first()[0]
    assert (e["enhanced"], e["negative"]) == ("<>", "no")


def test_scalars(spark):
    df = spark.createDataFrame([("24/1",), ("24000/1001",), ("0/0",), ("N/A",), ("",), ("23.976",), (None,), (" 3 ",), ("169.0",)], "x string")
    got = [tuple(r) for r in df.select(scalars.frame_rate(F.col("x")), scalars.lenient_int(F.col("x")), scalars.lenient_float(F.col("x"))).collect()]
    assert got == [(24.0, None, None), (23.976024, None, None), (None, None, None), (None, None, None), (None, None, None), (23.976, None, 23.976), (None, None, None), (3.0, 3, 3.0), (169.0, None, 169.0)]
    sizes = {"2g": 2 << 30, "1.5 MB": 1536 << 10, "4096": 4096, "1tb": 1 << 40, " 7K ": 7168, "10b": None, "x": None, "1.5": None, "": None}
    for s, n in sizes.items():
        if n is None:
            with pytest.raises(ValueError):
                scalars.parse_size(s)
        else:
            assert scalars.parse_size(s) == n
    got = {r[0]: r[1] for r in spark.createDataFrame([(s,) for s in sizes], "s string").select("s", scalars.size_bytes(F.col("s"))).collect()}
    assert got == sizes
    one = spark.range(1).select(
        scalars.task_id(F.lit("A"), F.lit(12345), F.lit("720p")), scalars.task_id(F.lit("A"), F.lit(7), F.lit("720p")), scalars.account(F.lit(13), list("ABCDEFGHIJ")), scalars.first_part(F.lit("")), scalars.last_part(F.lit("A_g1_480p")), scalars.owner(F.lit(None), F.lit("B_x")),
        scalars.file_stem(F.lit("a/b.c/d.e.mp4")), scalars.duration(F.lit(169), F.lit(24)), scalars.duration(F.lit(1), F.lit(0)), scalars.percent(F.lit(1), F.lit(0)), scalars.percent(F.lit(1), F.lit(3)), scalars.whole_mean(F.lit(7), F.lit(2)), scalars.u32(F.lit(bytearray(b"\x00\x00\x01\x02ftyp")), 1), scalars.tag(F.lit(bytearray(b"\x00\x00\x01\x02ftyp")), 5), scalars.shard_name(F.lit(3)), scalars.json_array(F.array(F.lit("é"))),
    ).first()
    assert tuple(one) == ("A_g12345_720p", "A_g0007_720p", "D", "?", "480p", "B", "d.e", 7.041667, None, 0.0, 33.3, 3, 258, "ftyp", "shards/train-00003.tar", '["é"]')


def test_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "n"), ("b", None, "q")], "k string, o int, v string")
    assert rows(keys.last_wins(df, ["k"], "o")) == [(None, 1, "n"), ("a", 2, "z"), ("b", None, "q")]
    assert keys.last_wins(df.limit(0), ["k"], "o").count() == 0
    low = spark.createDataFrame([("a", 9, "low"), ("c", 9, "low")], "k string, o int, v string")
    assert rows(keys.overlay([low, df.where("k = 'b'"), df.where("k = 'a'")], ["k"])) == [("a", 9, "low"), ("b", None, "q"), ("c", 9, "low")]
    assert rows(keys.duplicates(df, "k")) == [("a", 3)]
    with pytest.raises(keys.DuplicateKeys, match="null key, "):
        keys.unique(df, "k")
    assert keys.unique(low, "k").count() == 2
    many = spark.range(0, 1000, 1, 7)
    assert [r["n"] for r in keys.numbered(many, "n").orderBy("id").collect()] == list(range(1000))
    assert keys.numbered(many.limit(0), "n").count() == 0


def test_reconcile(spark):
    a = spark.createDataFrame([("1", "g", "x"), ("2", "g", "y"), ("3", "h", None), (None, "h", "z")], "k string, g string, v string")
    b = spark.createDataFrame([("2", "g", "y"), ("3", "h", "w"), ("4", "h", None)], "k string, g string, v string")
    assert rows(reconcile.presence(a, b, ["k"])) == [(None, True, False), ("1", True, False), ("2", True, True), ("3", True, True), ("4", False, True)]
    assert rows(reconcile.only_left(a, b, ["k"]).select("k")) == [(None,), ("1",)]
    assert rows(reconcile.within(a, b, ["k"]).select("k")) == [("2",), ("3",)]
    assert tuple(reconcile.cardinalities(a, b, ["k"]).first()) == (4, 3, 2, 2, 1)
    assert not reconcile.same_set(a, b, ["k"]).first()[0] and reconcile.same_set(a.limit(0), b.limit(0), ["k"]).first()[0]
    assert sorted(map(tuple, reconcile.member_differences(a.where("k is not null"), b, "g", "k").collect())) == [("g", "1", "missing"), ("h", "4", "extra")]
    assert rows(reconcile.value_differences(a.where("k is not null"), b, ["k"], "v")) == [("1", "x", None), ("3", None, "w"), ("4", None, None)]
    with pytest.raises(reconcile.Mismatch, match="only left"):
        reconcile.same_keys(a, b, ["k"])
    good = b.withColumn("v", F.lit("new"))
    assert {r["v"] for r in reconcile.refreshed(b, good, "k", ["v"]).collect()} == {"new"}
    with pytest.raises(reconcile.Mismatch, match="blank"):
        reconcile.refreshed(b, b, "k", ["v"])


def test_size_distribution(spark):
    import random

    from tessera.operators.profiling import matrix, nested_counts, progress, size_distribution, value_counts

    random.seed(4)
    held = {g: [random.choice([0, 1, 5 << 20, random.randrange(1 << 33)]) for _ in range(n)] for g, n in (("a", 101), ("b", 100), ("c", 1), (None, 6))}
    df = spark.createDataFrame([(g, s, "x") for g, v in held.items() for s in v] + [("a", None, "x"), ("z", None, "x")], "g string, n long, _s string").repartition(4)
    got = {r["g"]: tuple(r)[1:] for r in size_distribution(df, "g", "n").collect()}
    assert got == {g: (len(v), sum(v) // len(v), sorted(v)[len(v) // 2], min(v), max(v)) for g, v in held.items()}
    assert size_distribution(df.limit(0), "g", "n").count() == 0
    states = spark.createDataFrame([("1", "A", "done"), ("2", "A", None), ("3", "B", "odd"), ("4", None, "done")], "task_id string, account string, status string")
    assert rows(matrix(states, "account", "status", ["done"], "other")) == [(None, 1, 0, 1), ("A", 1, 1, 2), ("B", 0, 1, 1)]
    assert {r["account"]: r["counts"] for r in nested_counts(states, "account", "status").collect()} == {"A": {"done": 1, "?": 1}, "B": {"odd": 1}, "?": {"done": 1}}
    assert rows(value_counts(states, "status")) == [("done", 2), ("odd", 1)]
    assert tuple(progress(states, spark.range(6)).first()) == (6, 2, 4, 2, 33.3)
    assert tuple(progress(states.limit(0), spark.range(0)).first()) == (0, 0, 0, 0, 0.0)


def test_rules(spark):
    from tessera.operators import rules
    from tessera.plans.checks import project_violations

    tasks = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "task_id string")
    states = spark.createDataFrame([("a", "done"), ("b", None), ("x", "done")], "task_id string, status string")
    media = spark.createDataFrame([("a", 5), ("b", 5000), ("y", None)], "task_id string, length long")
    got = rows(project_violations(tasks, states, media, 10).select("rule_id", "subject"))
    assert got == sorted([("duplicate_task", "a"), ("missing_state", "c"), ("missing_state", None), ("missing_video", "c"), ("missing_video", None), ("not_done", "b"), ("not_done", "c"), ("not_done", None), ("small_or_empty", "a"), ("extra_state", "x"), ("extra_video", "y")], key=lambda r: tuple((x is not None, x) for x in r))
    assert project_violations(tasks.limit(0), states.limit(0), media.limit(0)).count() == 0
    many = spark.range(100).selectExpr("'r' rule_id", "'error' severity", "lpad(id, 3, '0') subject", "'' detail")
    s = rules.samples(many.unionByName(many), 3).first()
    assert (s["violations"], list(s["subjects"])) == (200, ["000", "001", "002"])
    assert tuple(rules.verdict(many.limit(0)).first()) == (True, 0, 0)
    shape = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 9)], "g int, k int")
    assert rows(rules.group_shape(shape, "g", "g", 3, 2).select("subject")) == [("2",), ("groups",)]
    assert rows(rules.key_domain(shape, "k", "k", [1, 2, 3], None).select("subject", "detail")) == [("3", "rows: 0"), ("9", "not in the domain")]
