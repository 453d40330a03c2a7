import random

from tessera.llm.splits import deal, grouped_splits, spanning_forest

TARGETS = [("test", 0.05), ("train", 0.9), ("validation", 0.05)]


def components(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for u, v in edges:
        if u is not None and v is not None:
            a, b = find(u), find(v)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_forest(spark):
    random.seed(5)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1080)] + [(2000, x) for x in range(2001, 2060)] + [(7, 7), (None, 3), (3, None), (3000, 3000), (5, 6), (6, 5), (5, 6)]
    labels, forest = spanning_forest(spark.createDataFrame(edges, "u int, v int"))
    want = components(edges)
    assert {r["node"]: r["root"] for r in labels.collect()} == want
    tree = [tuple(r) for r in forest.collect()]
    assert len(tree) == len(want) - len(set(want.values())) and components([*tree, *((x, x) for x in want)]) == want
    labels, forest = spanning_forest(spark.createDataFrame([], "u int, v int"))
    assert labels.count() == forest.count() == 0


def test_deal(spark):
    groups = spark.range(6000).selectExpr("id as group", "cast(case when id = 0 then 4000 when id < 50 then 30 else 1 + id % 4 end as long) as size")
    got = {r["group"]: r["split"] for r in deal(groups, TARGETS).collect()}
    size = {r["group"]: r["size"] for r in groups.collect()}
    assert set(got) == set(size)
    total = sum(size.values())
    for name, share in TARGETS:
        assert abs(sum(size[g] for g, s in got.items() if s == name) / total - share) < 0.01
    assert deal(groups.limit(0), TARGETS).count() == 0
    assert deal(groups.limit(1), TARGETS).collect()[0]["split"] == "train"


def test_grouped(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (None, "e"), (4, "f")], "n int, split string")
    ties = spark.createDataFrame([(1, 2), (9, 4), (None, 3)], "u int, v int")
    got = grouped_splits(rows, "n", ties, TARGETS).collect()
    assert len(got) == 7 and {r["split"] for r in got} <= {"train", "test", "validation"}
    keys = {r["n"]: r["group_key"] for r in got if r["n"]}
    assert keys[1] == keys[2] and len({keys[1], keys[3], keys[4]}) == 3
    assert len({r["group_key"] for r in got if r["n"] is None}) == 2
    assert grouped_splits(rows.limit(0), "n", ties, TARGETS).count() == 0
