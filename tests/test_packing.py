import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators.packing import _effect, next_fit, shard_summary


def fold(sizes, capacity):
    out, shard, fill, open_ = [], -1, 0, False
    for s in sizes:
        if not open_ or fill + s > capacity:
            shard, fill, open_ = shard + 1, 0, True
        fill += s
        out.append(shard)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 40), st.integers(0, 60))
def test_effect(sizes, capacity, fill):
    import numpy as np

    room, ends, starts = _effect(np.array(sizes), capacity)
    shard, f = 0, fill
    for s in sizes:
        if f + s > capacity:
            shard, f = shard + 1, 0
        f += s
    left = capacity - fill
    want = (fill + sum(sizes), 0) if left >= sum(sizes) else [(e, n) for r, e, n in zip(room, ends, starts) if r <= left][-1]
    assert want == (f, shard)


def test_next_fit(spark):
    random.seed(2)
    sizes = [random.choice([0, 1, 5, 40, 90, 150]) for _ in range(3000)]
    df = spark.createDataFrame([(f"k{i:05d}", s, i) for i, s in enumerate(sizes)], "k string, n long, shard_no int").repartition(5)
    for ranges in (1, 3, 16):
        got = [r["shard_no"] for r in next_fit(df, ["k"], "n", 100, ranges).orderBy("k").collect()]
        assert got == fold(sizes, 100)
    packed = next_fit(df, ["k"], "n", 100, 4)
    first = shard_summary(packed, "k", "n").orderBy("shard_no").first()
    assert first["first_key"] == "k00000" and first["bytes"] == sum(s for s, f in zip(sizes, fold(sizes, 100)) if f == 0)


def test_cases(spark):
    df = spark.createDataFrame([("a", None), ("b", 500), ("c", 0), ("c", 0), (None, 1)], "k string, n long")
    got = sorted(((r["k"] or ""), r["shard_no"]) for r in next_fit(df, ["k"], "n", 100).collect())
    assert got == [("", 0), ("a", 0), ("b", 1), ("c", 2), ("c", 2)]
    assert next_fit(df.limit(0), ["k"], "n", 100).count() == 0


def test_pieces_are_those_of_one_capacity():
    import numpy as np

    for size, capacity in ((5, 50), (5_000_000, 2 << 30), (1, 1000)):
        assert len(_effect(np.full(100_000, size), capacity)[0]) <= capacity // size + 1
    assert len(_effect(np.zeros(1000, np.int64), 10)[0]) == 1
    assert len(_effect(np.random.default_rng(1).integers(0, 10_000, 50_000), 100_000)[0]) < 100
