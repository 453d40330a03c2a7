import random

import numpy as np
import pyarrow as pa

from tessera.llm import near_duplicates as nd
from tests.llm.test_near_duplicates import brute


def joined(ts, frequent=1):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ts)), pa.int64()), pa.array(ts)], names=["tid", "text"])
    (counted,) = nd._counts(3)([batch])
    bucket, docs, *least = (c.to_numpy() for c in counted.columns)

    class Held:
        value = nd._clusters(bucket, docs * frequent, np.stack(least))

    return pa.Table.from_batches(list(nd._postings(3, 0.65, Held)([batch]))).sort_by([(c, "ascending") for c in nd.KEYS])


def test_one_row_for_a_cluster_that_60000_texts_share():
    """Copies of a row would grow with the square of the texts, and so would the disk."""
    rows = joined([f"a phrase of many texts, and {k} more" for k in range(10)], 6000).to_pylist()
    assert rows and len({(r["tid"], r["cluster"]) for r in rows}) == len(rows)


def test_blocks_of_a_large_group(monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 4)
    monkeypatch.setattr(nd, "ACROSS", 8)
    monkeypatch.setattr(nd, "DOWN", 16)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(12)]
    ts = sorted({" ".join([*rng.sample(words, 5), "what all of them end with", str(k % 7)]) for k in range(250)})
    rows = joined(ts)
    pairs = {(min(ts[a], ts[b]), max(ts[a], ts[b])) for out in nd._join(0.65)(rows.combine_chunks().to_batches()) for a, b in zip(*(out.column(c).to_pylist() for c in (0, 1)))}
    want = brute(ts, 3, 0.65)
    assert want and want <= pairs


def test_signatures_that_differ_everywhere():
    """Sums of six words pass what a byte holds; no pair that may differ so much is lost."""
    rows = joined(["".join(chr(0x4E00 + (k * 7 + s) % 20000) for k in range(600)) + "x" * 5 for s in range(3)] * 30)
    r = nd._Rows(rows.to_batches(), 0.65)
    n = len(r.tid)
    r.size, r.share, r.reach, r.before = np.full(n, 500, np.float32), np.full(n, 127, np.float32), np.full(n, 1e6, np.float32), np.full(n, -1)
    r.words = [np.where(np.arange(n) % 2, np.uint64(2**64 - 1) if k < 3 else np.uint64(2**62 - 1) >> np.uint64(3 * (k == 5)), np.uint64(0)) for k in range(nd.WORDS)]
    r.tid = np.arange(n)
    differ = sum(int(np.bitwise_count(w[0] ^ w[1])) for w in r.words)
    assert differ > 256
    same = {(min(x, y), max(x, y)) for x, y in zip(*r.large(0, n))}
    assert same == {(x, y) for x in range(n) for y in range(x + 1, n) if (x - y) % 2 == 0}
