import random

from tessera.llm import near_duplicates as nd
from tessera.llm.near_duplicates import near_duplicates, similar_texts, similarity

random.seed(3)


def texts():
    phrases = ["".join(random.choices("abcdefgh 漢字仮", k=random.randint(4, 14))) for _ in range(40)]
    out = set()
    while len(out) < 150:
        p = random.choices(phrases, k=random.randint(1, 6))
        t = ", ".join(p)
        out.add(t)
        if random.random() < 0.5:
            k = random.randrange(len(t))
            out.add(t[:k] + random.choice("xyz") + t[k + 1 :])
            out.add(", ".join(reversed(p)))
    return sorted(out)


def brute(ts, n, threshold):
    out = set()
    for i, a in enumerate(ts):
        for b in ts[i + 1 :]:
            both, either = similarity(a, b, n)
            if either and both >= threshold * either - 1e-9:
                out.add((a, b))
    return out


def test_join_is_exact(spark, monkeypatch):
    ts = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "tid long, text string").repartition(3)
    for n, threshold in ((3, 0.65), (5, 0.8), (2, 0.5)):
        got = {tuple(sorted((ts[r["tid_a"]], ts[r["tid_b"]]))) for r in similar_texts(df, n, threshold).collect()}
        assert got == brute(ts, n, threshold) and got


def test_parts_and_large_groups(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(nd, "CHUNK", 8)
    monkeypatch.setattr(nd, "SMALL", 4)
    ts = texts()
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ts)), pa.int64()), pa.array(ts)], names=["tid", "text"])
    (counted,) = nd._counts(3)([batch])
    bucket, docs, *least = (c.to_numpy() for c in counted.columns)

    class Held:
        value = nd._clusters(bucket, docs, np.stack(least))

    rows = pa.Table.from_batches(list(nd._postings(3, 0.65, Held)([batch]))).sort_by([(c, "ascending") for c in (*nd.KEYS, "size")])
    pairs = {(min(ts[a], ts[b]), max(ts[a], ts[b])) for out in nd._join(0.65)(rows.combine_chunks().to_batches(max_chunksize=50)) for a, b in zip(*(out.column(c).to_pylist() for c in (0, 1)))}
    want = brute(ts, 3, 0.65)
    assert want <= pairs and len(pairs) < 4 * len(want) + 50


def test_frame(spark):
    rows = [(1, "the quick brown fox jumps"), (2, "the quick brown fox jumps"), (3, "the quick brown fox jumped"), (3, "zz"), (4, "zz"), (5, None), (None, "zz"), (6, ""), (7, ""), (8, "q" * 20000), (9, "q" * 20001), (1, "the quick brown fox jumps")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "g int, p string, tid int")
    members, pairs = near_duplicates(df, "g", "p", 3, 0.65)
    by = {}
    for r in members.collect():
        by.setdefault(r["tid"], set()).add(r["g"])
    assert sorted(map(sorted, by.values())) == [[1, 2], [3], [3, 4], [6, 7], [8], [9]]
    linked = [tuple(sorted((min(by[r["tid_a"]]), min(by[r["tid_b"]])))) for r in pairs.collect()]
    assert sorted(linked) == [(1, 3), (8, 9)]
    members, pairs = near_duplicates(df.limit(0), "g", "p", 3, 0.65)
    assert members.count() == pairs.count() == 0


def test_hot_copies(spark):
    df = spark.range(1500).selectExpr("cast(id as int) g", "if(id % 3 = 0, 'a text that many rows share', concat('row of its own ', sha1(cast(id as string)))) p")
    members, pairs = near_duplicates(df.unionByName(spark.createDataFrame([(9999, "a text that many rows shared")], "g int, p string")), "g", "p", 3, 0.65)
    assert members.count() == 1501 and members.select("tid").distinct().count() == 1002
    assert pairs.count() == 1
