import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing
from tessera.llm.packing import curve_keys, filled, hilbert, pack, packed_files


def test_hilbert_steps_to_neighbours():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = hilbert(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_equal_texts_have_equal_keys():
    a, b, c, d = curve_keys(["one and the same", "one and the same", None, ""])
    assert a == b and c == d


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=200), st.integers(100, 300), st.integers(1, 50))
def test_pack(sizes, capacity, window):
    place = pack(sizes, capacity, window)
    fills = {}
    for s, p in zip(sizes, place, strict=True):
        fills[p] = fills.get(p, 0) + s
    assert all(f <= capacity for f in fills.values())
    assert sorted(fills) == list(range(len(fills)))
    # no two of the containers could be one, but for the last ones of the window
    assert len(fills) <= max(1, 2 * sum(sizes) / capacity + 1)


def test_filled(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_FILLS", 4)
    monkeypatch.setattr(packing, "RANGE_LEAST", 100)
    rng = np.random.default_rng(1)
    rows = [(f"i{k}", int(s), int(k % 97)) for k, s in enumerate(rng.integers(0, 400, 900))] + [("big", 3500, 5), ("even", 2000, 6), ("even", 2000, 6), ("none", 0, 1)]
    got = filled(spark.createDataFrame(rows, "item string, bytes long, key long"), 1000).collect()
    assert sum(r["bytes"] for r in got) == sum(r[1] for r in rows)
    shards = {}
    for r in got:
        shards[r["shard"]] = shards.get(r["shard"], 0) + r["bytes"]
    assert sorted(shards) == list(range(len(shards))) and max(shards.values()) <= 1000
    assert len(shards) <= 1.05 * sum(r[1] for r in rows) / 1000 + 2
    assert sorted((r["piece"], r["bytes"]) for r in got if r["item"] == "big") == [(0, 1000), (1, 1000), (2, 1000), (3, 500)]
    assert sum(r["item"] == "even" for r in got) == 4


def test_files(spark):
    rows = [("a", 10, "x", 1), ("a", 10, "x", 1), ("b", None, "y", 1), ("c", -5, None, 1), (None, 4, "z", 1), ("d", 25, "w" * 50000, 1), ("e", 0, "", 1)]
    files = spark.createDataFrame(rows, "f string, n long, t string, shard int")
    got = packed_files(files, "f", "n", "t", [("p", 10), ("q", 100)]).collect()
    q = {(r["f"], r["piece"], r["bytes"], r["shard"]) for r in got if r["limit_name"] == "q"}
    assert q == {("a", 0, 10, 0), ("b", None, None, None), ("c", None, None, None), ("d", 0, 25, 0), ("e", 0, 0, 0)}
    assert sorted((r["piece"], r["bytes"]) for r in got if r["f"] == "d" and r["limit_name"] == "p") == [(0, 10), (1, 10), (2, 5)]
    assert packed_files(files.limit(0), "f", "n", "t", [("p", 10)]).count() == 0


def test_pack_is_close_to_the_bytes():
    rng = np.random.default_rng(4)
    for sizes, capacity in ((rng.lognormal(15, 1.2, 8000).astype(int), 1 << 28), (rng.integers(1, 1000, 8000), 20_000), (rng.lognormal(10, 2, 8000).astype(int), 1 << 24)):
        sizes = np.minimum(sizes, capacity)
        shards = max(pack(sizes.tolist(), capacity)) + 1
        assert shards <= 1.01 * sizes.sum() / capacity + 1
