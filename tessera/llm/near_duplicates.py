"""Near-duplicates with small edits: an exact similarity join of n-gram sets.

Grams are ordered by the texts that hold them, for the grams of their cluster, few first (any one order is right), and grams that stand in the same texts, as those of one phrase do, follow each other as one
cluster: told by document counts and three least hashes of the texts in tables of fixed size. Two sets of similarity t share a gram in their prefixes,
so prefixes are joined cluster by cluster: one row per text and cluster of its prefix grams. A pair is taken up only where
lengths and places leave room for the overlap it needs (length and positional filter), where the cluster is not known to be
the second shared one, and where a lower bound of the number of grams they differ in from there on allows it (suffix filter, by
384-bit parity signatures of the suffixes in place of recursive probing). What is left is made distinct and verified once per pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, shuffle_partitions

#: Buckets of the tables of grams; a cluster number and a count of each go to all executors (8 bytes a bucket).
BUCKETS = 1 << 20
#: Least hashes of its texts that a gram is clustered by.
LEAST = 3
#: Rows of one cluster joined at once; a cluster in more texts is split into parts that are joined pair by pair.
CHUNK = 1 << 17
#: Groups up to this size are joined together, offset by offset; larger ones row against column.
SMALL = 64
#: 64-bit words of a signature.
WORDS = 6
#: Rows and columns compared at once, which fit the processor's cache; a word of the signature for so many bits that a pair may differ in.
ACROSS, DOWN, BITS_A_WORD = 64, 1024, 20
#: Grams of a cluster that count in the order. The one of a template that all texts share has many, and would be a group of all texts.
GRAMS = 16
_SLACK = 1e-3


def grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of n code points of each text: number of the text, gram. Exact up to n = 3 (21 bits each), hashed beyond."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = len(codes) - n + 1
    g = np.zeros(size, np.uint64)
    for k in range(n):
        g = (g << np.uint64(21) if n <= 3 else g * np.uint64(0x9E3779B97F4A7C15)) + codes[k : k + size]
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = owner[:size] == owner[n - 1 :]
    doc, g = owner[:size][inside], (g[inside] & np.uint64(2**63 - 1)).astype(np.int64)
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])
    return doc[new], g[new]


def _mixed(g: np.ndarray) -> np.ndarray:
    h = g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def _bucket(g: np.ndarray) -> np.ndarray:
    return (_mixed(g) >> np.uint64(44)).astype(np.int64)


def _counts(n: int):
    names = ["bucket", "docs", *[f"least_{k}" for k in range(LEAST)]]

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        least = np.full((LEAST, BUCKETS), np.iinfo(np.int64).max)
        for batch in batches:
            doc, g = grams(batch.column("text").to_pylist(), n)
            bucket, tid = _bucket(g), batch.column("tid").to_numpy()
            total += np.bincount(bucket, minlength=BUCKETS)
            for k in range(LEAST):
                h = (_mixed(tid * LEAST + k + 1) >> np.uint64(2)).astype(np.int64)
                np.minimum.at(least[k], bucket, h[doc])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held]), *[pa.array(x[held]) for x in least]], names=names)

    return counts


def _clusters(bucket: np.ndarray, docs: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By bucket the number of its cluster, first those of few texts for their grams, and by cluster how many texts hold its most frequent gram."""
    cluster = np.unique(least, axis=1, return_inverse=True)[1].ravel() if len(bucket) else np.zeros(0, np.int64)
    most = np.zeros(int(cluster.max(initial=-1)) + 1, np.int64)
    np.maximum.at(most, cluster, docs)
    order = np.argsort(most / np.clip(np.bincount(cluster), 1, GRAMS), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = np.zeros(BUCKETS, np.int32)
    number[bucket] = rank[cluster]
    return number, most[order].astype(np.int32)


POSTING = "cluster int, part_a int, part_b int, part int, tid long, size int, place int, before int, signature binary"
KEYS = ("cluster", "part_a", "part_b")


def _postings(n: int, threshold: float, tables_of):
    def postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, most = tables_of.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                tid = batch.column("tid").to_numpy()
                doc, g = grams(batch.column("text").to_pylist(), n)
                if not len(g):
                    continue
                cluster = number[_bucket(g)]
                order = np.lexsort((cluster, doc))  # doc stays in order
                g, cluster = g[order], cluster[order]
                size = np.bincount(doc, minlength=len(tid))
                first = np.cumsum(size) - size
                place = np.arange(len(g)) - first[doc]
                # parity of the grams from each place on: running parity over the batch, taken away from that at the text's end
                bit = (_mixed(g) >> np.uint64(9)).astype(np.int64) % (WORDS * 64)
                running = np.zeros((len(g) + 1, WORDS), np.uint64)
                running[np.arange(1, len(g) + 1), bit >> 6] = np.uint64(1) << (bit & 63).astype(np.uint64)
                np.bitwise_xor.accumulate(running, axis=0, out=running)
                # a row where a cluster begins; one that no other text has joins nothing
                heads = np.ones(len(g), bool)
                heads[1:] = (cluster[1:] != cluster[:-1]) | (place[1:] == 0)
                keep = np.flatnonzero(heads & (place <= size[doc] - np.ceil(threshold * size[doc] - 1e-9)) & (most[cluster] > 1))
                before = np.full(len(keep), -1, np.int32)
                follows = doc[keep[1:]] == doc[keep[:-1]]
                before[1:][follows] = cluster[keep[:-1]][follows]
                parts = -(-most[cluster[keep]] // CHUNK)
                own = (_mixed(tid[doc[keep]] + 1) >> np.uint64(33)).astype(np.int64) % parts
                row = np.repeat(np.arange(len(keep)), parts)
                other = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                k, mine = keep[row], own[row]
                d = doc[k]
                signature = running[(first + size)[d]] ^ running[k]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cluster[k]),
                        pa.array(np.minimum(mine, other).astype(np.int32)),
                        pa.array(np.maximum(mine, other).astype(np.int32)),
                        pa.array(mine.astype(np.int32)),
                        pa.array(tid[d]),
                        pa.array(size[d].astype(np.int32)),
                        pa.array(place[k].astype(np.int32)),
                        pa.array(before[row]),
                        pa.FixedSizeBinaryArray.from_buffers(pa.binary(WORDS * 8), len(d), [None, pa.py_buffer(signature)]).cast(pa.binary()),
                    ],
                    names=[*KEYS, "part", "tid", "size", "place", "before", "signature"],
                )

    return postings


class _Rows:
    """Posting rows as arrays, with what the filters need."""

    def __init__(self, batches: list[pa.RecordBatch], threshold: float) -> None:
        t = pa.Table.from_batches(batches)
        col = lambda c: t.column(c).to_numpy()
        self.cluster, self.a, self.b, self.part = col("cluster"), col("part_a"), col("part_b"), col("part")
        self.tid, self.size, self.before = col("tid"), col("size").astype(np.float32), col("before")
        ratio = threshold / (1 + threshold)
        # partner's size that the rest of this set can still reach the overlap for
        self.reach = ((self.size - col("place")) / ratio - self.size + _SLACK).astype(np.float32)
        signature = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint64).reshape(-1, WORDS)
        self.words = [np.ascontiguousarray(signature[:, w]) for w in range(WORDS)]
        # a pair's sets may differ in the sum of its two shares from this place on, if all before it differ
        self.share = (self.size * (1 - 2 * ratio) - col("place") + _SLACK).astype(np.float32)

    def first_ok(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs (as rows) that pass the length and positional filters, differ in the cluster before, and belong to this part."""
        ok = (self.reach[i] >= self.size[j]) & (self.reach[j] >= self.size[i])
        ok &= (self.before[i] != self.before[j]) | (self.before[i] < 0)
        return ok & ((self.part[i] != self.part[j]) | (self.a[i] == self.b[i])) & (self.tid[i] != self.tid[j])

    def large(self, start: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of one large group. Rows in order of their share: a row meets only those whose share leaves any difference to the pair, and
        most pairs end with the first words of their signatures, compared row against column: fewer where little difference is left."""
        back = np.argsort(-self.share[start : start + count], kind="stable") + start
        share = self.share[back]
        words = [w[back] for w in self.words]
        differ, bits, more = np.empty((ACROSS, DOWN), np.uint64), np.empty((ACROSS, DOWN), np.uint8), np.empty((ACROSS, DOWN), np.uint8)
        found = [(back[:0], back[:0])]
        for at in range(0, count, ACROSS):
            if 2 * share[at] < 0:
                break
            top, end = slice(at, min(at + ACROSS, count)), int(np.searchsorted(-share, share[at], side="right"))
            # what the first of these rows leaves, as no other leaves more
            left = np.clip(np.floor(share[at] + share[at:end]), 0, 255).astype(np.uint8)
            near = []
            for to in range(at, end, DOWN):
                right, allowed = slice(to, min(to + DOWN, end)), left[to - at : to - at + DOWN]
                x, n, m = (b[: top.stop - at, : right.stop - to] for b in (differ, bits, more))
                for k in range(min(WORDS, 1 + int(allowed[0]) // BITS_A_WORD)):
                    np.bitwise_xor(words[k][top, None], words[k][None, right], out=x)
                    np.bitwise_count(x, out=m if k else n)
                    if k > 2:  # four words may differ in over 255 bits: too low a sum only keeps the pair for close()
                        np.minimum(n, 191, out=n)
                    if k:
                        n += m
                i, j = np.divmod(np.flatnonzero(n <= allowed), n.shape[1])
                near.append((i + at, j + to))
            i, j = np.concatenate([i for i, _ in near]), np.concatenate([j for _, j in near])
            upper = j > i
            i, j = back[i[upper]], back[j[upper]]
            ok = self.first_ok(i, j)
            found.append(self.close(i[ok], j[ok]))
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])

    def close(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix filter. If this cluster is the first that a pair shares, all grams before it differ; those from here on may differ in
        no more than what is left. Their parity signatures differ in at most as many bits. (If it isn't the first, the pair is met there.)"""
        out_i, out_j = [i[:0]], [j[:0]]
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            allowed, bits = self.share[x] + self.share[y], np.zeros(len(x), np.uint16)
            for word in self.words:
                bits += np.bitwise_count(word[x] ^ word[y])
                near = np.flatnonzero(bits <= allowed)
                x, y, allowed, bits = x[near], y[near], allowed[near], bits[near]
            out_i.append(x)
            out_j.append(y)
        return np.concatenate(out_i), np.concatenate(out_j)


def _pairs_of(rows: _Rows) -> tuple[np.ndarray, np.ndarray]:
    n = len(rows.cluster)
    new = np.ones(n, bool)
    new[1:] = (rows.cluster[1:] != rows.cluster[:-1]) | (rows.a[1:] != rows.a[:-1]) | (rows.b[1:] != rows.b[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    end = np.repeat(start + size, size)
    active = np.flatnonzero(np.repeat(size <= SMALL, size))
    for k in range(1, SMALL):
        active = active[active + k < end[active]]
        if not len(active):
            break
        ok = rows.first_ok(active, active + k)
        found.append(rows.close(active[ok], active[ok] + k))
    for s, m in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        found.append(rows.large(s, m))
    i = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    j = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.int64)
    a, b = rows.tid[i], rows.tid[j]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
    return pairs[:, 0], pairs[:, 1]


def _join(threshold: float):
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def done(part: list[pa.RecordBatch]) -> pa.RecordBatch:
            a, b = _pairs_of(_Rows(part, threshold))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["tid_a", "tid_b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # rows come sorted: whatever precedes the last group of the batch is whole
            key = [batch.column(c).to_numpy() for c in KEYS]
            differs = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
            cut_at = int(differs[-1]) + 1 if len(differs) else 0
            rows += batch.num_rows
            if cut_at and rows >= 60_000:
                yield done([*held, batch.slice(0, cut_at)])
                held, rows = [batch.slice(cut_at)], batch.num_rows - cut_at
            else:
                held.append(batch)
        if held:
            yield done(held)

    return join


def similarity(a: str, b: str, n: int) -> tuple[int, int]:
    """Distinct n-grams in both texts and in either."""
    x, y = {a[i : i + n] for i in range(len(a) - n + 1)}, {b[i : i + n] for i in range(len(b) - n + 1)}
    both = len(x & y)
    return both, len(x) + len(y) - both


def _verify(n: int, threshold: float):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [similarity(a, b, n) for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)]
            keep = [k for k, (i, u) in enumerate(both) if i >= threshold * u - 1e-9]
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("tid_a").take(rows), batch.column("tid_b").take(rows), pa.array([both[k][0] / both[k][1] for k in keep], pa.float64())], names=["tid_a", "tid_b", "similarity"])

    return verify


def similar_texts(texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """``tid_a, tid_b, similarity`` (a < b): all pairs of different texts whose sets of character n-grams have at least that Jaccard similarity.

    texts: ``tid BIGINT`` (unique), ``text`` (distinct, not null); read several times, so best a written table. Texts shorter than n have no
    grams and no pair.
    """
    spark = texts.sparkSession
    least = [f"least_{k}" for k in range(LEAST)]
    sums = texts.mapInArrow(_counts(n), f"bucket long, docs long, {', '.join(f'{c} long' for c in least)}")
    counted = sums.groupBy("bucket").agg(F.sum("docs").alias("docs"), *[F.min(c).alias(c) for c in least]).toArrow()  # at most BUCKETS rows
    column = lambda c: counted.column(c).to_numpy()
    tables_of = spark.sparkContext.broadcast(_clusters(column("bucket"), column("docs"), np.stack([column(c) for c in least])))
    postings = texts.mapInArrow(_postings(n, threshold, tables_of), POSTING)
    joined = postings.repartition(4 * shuffle_partitions(spark), *KEYS).sortWithinPartitions(*KEYS).mapInArrow(_join(threshold), "tid_a long, tid_b long")
    pairs = cut(joined.distinct())
    side = lambda s: texts.select(F.col("tid").alias(f"tid_{s}"), F.col("text").alias(f"text_{s}"))
    return pairs.join(side("a"), "tid_a").join(side("b"), "tid_b").select("tid_a", "tid_b", "text_a", "text_b").mapInArrow(_verify(n, threshold), "tid_a long, tid_b long, similarity double")


def near_duplicates(df: DataFrame, id_column: str, text_column: str, n: int, threshold: float, form=None) -> tuple[DataFrame, DataFrame]:
    """Members and pairs of near-duplicate texts: ``<id>, tid`` (one row per id and class of equal texts) and ``tid_a, tid_b, similarity``.

    Equal texts are one class and are not paired with each other; no pair of different classes is lost and none is drawn twice.
    ``form``: a function from (frame, column) to ``text, canonical`` that brings texts to one form first. Null ids and texts are
    left out; a text shorter than n is equal to itself only; an id may belong to several classes; repeated rows count once; other
    columns are ignored; an empty table gives two empty ones.
    """
    digest = lambda c: F.unhex(F.sha2(F.col(c), 256))
    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text")).where("_id IS NOT NULL AND text IS NOT NULL")
    members = rows.select("_id", digest("text").alias("_text")).distinct()
    forms = cut(form(rows, "text").select(digest("text").alias("_text"), "canonical") if form is not None else rows.select("text").distinct().select(digest("text").alias("_text"), F.col("text").alias("canonical")))
    # texts move once more, to be made distinct in their form; ids meet them by digests
    classes = cut(forms.select("canonical").distinct().select(F.monotonically_increasing_id().alias("tid"), F.col("canonical").alias("text")))
    numbers = classes.select("tid", digest("text").alias("_form"))
    members = members.join(forms.select("_text", digest("canonical").alias("_form")), "_text").join(numbers, "_form")
    members = members.select(F.col("_id").alias(id_column), "tid").distinct()
    return members, similar_texts(classes, n, threshold)
