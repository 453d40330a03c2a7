"""Evaluation texts leaking into training text, by the q-gram lemma.

A stretch of ``length`` characters kept with at most ``edits`` edits shares at least ``length - q + 1 - q * edits`` q-grams
with its source, all within a band of ``2 * edits + 1`` diagonals (place in the document less place in the item).
All q-grams of a document are looked up in the index of the items, which holds every STRIDE-th of theirs (each kept stretch between edits
loses less than one more by that), hits are counted in overlapping
diagonal bands, and bands that reach the bound of their item are verified by banded alignment. The index
of a block of items is the only thing sent to the executors: some 11 bytes a character. Larger sets are taken block by block, each a scan of the
documents whose result is written before the next block is indexed, so that one index is alive at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, ship

#: Characters of a q-gram, edits allowed in a leaked stretch, and the words such a stretch has at least.
Q, EDITS, WORDS = 16, 1, 12
#: Diagonals by which one band begins after the other; a band has twice as many.
STEP = 8
#: Places in an item of which one is indexed.
STRIDE = 4
#: Bytes of item text that are indexed and sent out at once (an index of at most 90 MB), and matches that are counted at once.
BLOCK_BYTES, MATCHES = 8 << 20, 1 << 21
#: Cost of an edit in the alignment; a kept character counts 1.
PENALTY = 3
#: Code points that are read at once, and after which a long text is cut into parts (which overlap by more than an item).
SCAN, SEGMENT = 1 << 22, 1 << 20


@lru_cache(maxsize=1)
def _shapes() -> np.ndarray:
    """By code point: 0 for what is no letter or digit, else its lower case."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalnum():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def plain_words(text: str) -> np.ndarray:
    """Code points of the words of ``text`` in lower case, a blank before, between and after them."""
    return _compact(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))[0]


def _compact(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = _shapes()[np.concatenate([np.zeros(1, np.uint32), raw, np.zeros(1, np.uint32)])]
    keep = low != 0
    keep[1:] |= low[:-1] != 0
    keep[0] = True
    low[low == 0] = 32
    return low[keep], keep


def _hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each run of q (a power of two) code points."""
    h, width, base = codes.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while width < q:
        h = h[:-width] * np.uint64(base) + h[width:] if len(h) > width else h[:0]
        width, base = width * 2, (base * base) % 2**64
    return h ^ (h >> np.uint64(29))


def _word_runs(codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of plain words: where each whole word (one between blanks) begins and the last ends plus one, and a 64-bit hash of each run of ``words`` words."""
    blank = np.flatnonzero(codes == 32)
    if len(blank) <= words:
        return blank + 1, np.zeros(0, np.uint64)
    # hash of each prefix of the characters, words told apart by their blanks; runs are differences brought to one scale
    powers = _powers(int(np.diff(blank).max()) + 1)
    size = np.diff(blank)
    begin = blank[:-1] + 1
    place = np.arange(int(blank[0]) + 1, int(blank[-1]) + 1)
    weights = powers[place - np.repeat(begin, size)]
    word = np.add.reduceat(codes[place].astype(np.uint64) * weights, begin - begin[0])
    word ^= word >> np.uint64(31)
    word *= np.uint64(0xD6E8FEB86659FD93)
    run = word[: len(word) - words + 1].copy()
    for k in range(1, words):
        run = run * np.uint64(0x9E3779B97F4A7C15) + word[k : len(word) - words + 1 + k]
    return blank + 1, run


@lru_cache(maxsize=4)
def _power_table(bits: int) -> np.ndarray:
    out = np.ones(1 << bits, np.uint64)
    out[1:] = np.uint64(0x9E3779B97F4A7C15)
    return np.multiply.accumulate(out)


def _powers(n: int) -> np.ndarray:
    return _power_table(max(6, (n - 1).bit_length()))


def _pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose sizes sum to about ``most`` at most."""
    sums, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


class Index:
    """The q-grams of a block of items and what their leaked stretches must reach."""

    def __init__(self, items: list[tuple[int, str]], words: int = WORDS, edits: int = EDITS) -> None:
        self.words, self.edits = words, edits
        codes, least, ids, begins, runs = [], [], [], [], []
        for item, text in items:
            c = plain_words(text)
            at, h = _word_runs(c, words)
            if not len(h):
                continue  # too short to leak a stretch of that many words
            codes.append(c.astype(np.uint16 if c.max() < 1 << 16 else np.uint32))
            ids.append(item)
            # a run of words, with the blanks around it
            least.append(int((at[words:] - at[:-words]).min()) + 1)
            begins.append(at.astype(np.int32))
            runs.append(h)
        self.ids, self.codes, self.begins, self.runs = np.array(ids, np.int64), codes, begins, runs
        self.least = np.array(least, np.int64)
        #: the bound of the q-gram lemma for every STRIDE-th q-gram of the edits + 1 kept parts; at least one must remain
        self.bound = np.maximum(1, -(-(self.least - Q + 1 - Q * edits - (STRIDE - 1) * (edits + 1)) // STRIDE))
        grams = [_hashes(c)[::STRIDE] for c in codes]
        place = np.concatenate([np.arange(len(g), dtype=np.int32) * STRIDE for g in grams]) if grams else np.zeros(0, np.int32)
        owner = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams]) if grams else np.zeros(0, np.int32)
        grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.grams, starts = np.unique(grams[order], return_index=True)
        self.starts = np.append(starts, len(grams)).astype(np.int32)
        self.place, self.owner = place[order], owner[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.grams >> np.uint64(42)).astype(np.int64)] = True

    def size(self) -> int:
        """Bytes of the index."""
        return sum(x.nbytes for x in (self.grams, self.starts, self.place, self.owner, self.seen, *self.codes, *self.begins, *self.runs))

    def regions(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of several documents' codes, laid end to end and beginning at ``starts``: document, item and the lowest diagonal of each band that reaches its bound."""
        none = (np.zeros(0, np.int64),) * 3
        h = _hashes(codes)
        at = np.flatnonzero(self.seen[(h >> np.uint64(42)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            return none
        k = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        hit = self.grams[k] == h[at]
        at, k = at[hit], k[hit]
        doc = np.searchsorted(starts, at, side="right") - 1
        enough = np.bincount(doc, minlength=len(starts)) >= (self.bound.min() if len(self.bound) else 1)
        at, k, doc = (x[enough[doc]] for x in (at, k, doc))
        if not len(at):
            return none
        # bands of all diagonals there can be, so that parts of the matches can be counted by themselves
        longest = max(map(len, self.codes))
        shift = -(-longest // STEP) + 1
        bands = shift + int(np.diff(np.append(starts, len(codes))).max()) // STEP + 2
        n = (self.starts[k + 1] - self.starts[k]).astype(np.int64)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b in _pieces(n, MATCHES):
            each = n[a:b]
            which = np.repeat(self.starts[k[a:b]].astype(np.int64), each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            owner = np.repeat(doc[a:b], each)
            diagonal = np.repeat(at[a:b], each) - starts[owner] - self.place[which]
            key = (owner * len(self.ids) + self.owner[which]) * bands + np.floor_divide(diagonal, STEP) + shift
            new, times = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            keys, index = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(index, np.concatenate([counts, times])).astype(np.int64)
        pair, low = np.divmod(keys, bands)
        item = pair % len(self.ids)
        good = counts >= self.bound[item]
        return (pair // len(self.ids))[good], item[good], ((low - shift) * STEP)[good]

    def align(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, item: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best local alignment of each region within its band: score, where it ends in the item and in the document."""
        width, n = 2 * STEP + 2 * self.edits, len(doc)
        low = low - self.edits
        m = np.array([len(self.codes[i]) for i in item], np.int64)
        texts = np.zeros((n, int(m.max())), np.uint32)
        for r, i in enumerate(item):
            texts[r, : m[r]] = self.codes[i]
        s = np.zeros((n, width + 2), np.int32)
        best, best_i, best_b = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        band = np.arange(width)
        rows = np.arange(n)
        for i in range(texts.shape[1]):
            at = starts[doc][:, None] + i + low[:, None] + band
            inside = (at >= starts[doc][:, None]) & (at < ends[doc][:, None]) & (i < m)[:, None]
            same = inside & (codes[np.clip(at, 0, len(codes) - 1)] == texts[:, i][:, None])
            new = np.maximum(s[:, 1:-1] + np.where(same, 1, -PENALTY), s[:, 2:] - PENALTY)
            np.maximum(new, 0, out=new)
            for b in range(1, width):
                np.maximum(new[:, b], new[:, b - 1] - PENALTY, out=new[:, b])
            new[~inside] = 0
            s[:, 1:-1] = new
            top = new.argmax(1)
            value = new[rows, top]
            better = value > best
            best[better], best_i[better], best_b[better] = value[better], i, top[better]
        return best, best_i, best_i + low + best_b

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int, bool]]:
        """Number of text, item id, characters kept at most, score, and whether ``words`` consecutive words are the same."""
        lengths = np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes, keep = _compact(raw)
        where = np.cumsum(keep) - 1  # place of each kept character (one blank was put in front)
        begin = np.cumsum(lengths + 1) - (lengths + 1)
        # the blank before the first word belongs to the text before; both share it
        starts = np.minimum(where[begin], len(codes) - 1)
        ends = np.append(starts[1:], len(codes) - 1) + 1
        out: dict[tuple[int, int], list] = {}
        for docs, first, last in _segments(starts, ends, max(map(len, self.codes), default=0) + 4 * STEP):
            base = int(first.min())
            self._verified(codes[base : int(last.max())], docs, first - base, last - base, out)
        return [(d, int(self.ids[i]), len(self.codes[i]), s, exact) for (d, i), (s, exact) in sorted(out.items())]

    def _verified(self, codes: np.ndarray, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, out: dict[tuple[int, int], list]) -> None:
        part, item, low = self.regions(codes, starts)
        for a in range(0, len(part), 4096):
            d, i, lo = part[a : a + 4096], item[a : a + 4096], low[a : a + 4096]
            score = self.align(codes, starts, ends, d, i, lo)[0]
            good = score >= np.maximum(1, self.least[i] - self.edits * (1 + PENALTY))
            for r in np.flatnonzero(good):
                # the band's whole stretch: the same words may stand outside the best alignment
                begin = int(starts[d[r]] + lo[r])
                first, last = max(int(starts[d[r]]), begin - self.edits), begin + len(self.codes[i[r]]) + 2 * STEP + self.edits
                held = out.setdefault((int(docs[d[r]]), int(i[r])), [0, False])
                held[0], held[1] = max(held[0], int(score[r])), held[1] or self._same_words(codes[first : min(int(ends[d[r]]), last)], int(i[r]))

    def _same_words(self, codes: np.ndarray, item: int) -> bool:
        """Whether a run of words of the item stands in ``codes``: by hash, then character by character."""
        own, at = self.codes[item], self.begins[item]
        there, hashes = _word_runs(codes, self.words)
        for k in np.flatnonzero(np.isin(hashes, self.runs[item])):
            said = codes[there[k] : there[k + self.words]]
            for r in np.flatnonzero(self.runs[item] == hashes[k]):
                if np.array_equal(own[at[r] : at[r + self.words]], said):
                    return True
        return False


def _segments(starts: np.ndarray, ends: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents in groups of bounded size, long ones in overlapping parts: number of the document, begin and end of each."""
    group: list[tuple[int, int, int]] = []
    as_arrays = lambda g: tuple(np.array(x) for x in zip(*g, strict=True))
    for d, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        if group and b - group[0][1] > 2 * SEGMENT:
            yield as_arrays(group)
            group = []
        if b - a <= 2 * SEGMENT:
            group.append((d, a, b))
            continue
        for at in range(a, b - overlap, SEGMENT):  # each part by itself, as they overlap
            yield as_arrays([(d, at, min(b, at + SEGMENT + overlap))])
    if group:
        yield as_arrays(group)


def _scan(index):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            rows: list[tuple] = []
            part, size = [], 0
            for r, text in enumerate([*texts, None]):
                if text is not None:
                    part.append(r)
                    size += len(text)
                if part and (size >= SCAN or r == len(texts)):
                    rows += [(part[d], *rest) for d, *rest in own.leaks([texts[p] for p in part])]
                    part, size = [], 0
            if rows:
                at, item, length, score, exact = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(item, pa.int64()), pa.array(length, pa.int32()), pa.array(score, pa.int32()), pa.array(exact)], names=["doc", "item", "item_chars", "score", "exact_words"]
                )

    return scan


def leaked_items(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, words: int = WORDS, edits: int = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``<doc_id>, <item_id>, item_chars, score, exact_words``: documents that hold a stretch of an item.

    A stretch has at least the length of the item's shortest run of ``words`` words and at most ``edits`` character edits, compared
    as lower-case runs of letters or digits parted by single blanks; ``score`` is the best alignment (kept characters less 3 an edit),
    ``exact_words`` tells that ``words`` consecutive words are the same. Null and empty texts, and items of
    fewer words, are no case; rows are judged one by one, so repeated rows come out as often; items that repeat an id count
    together; other columns are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[doc_id].dataType.simpleString()
    wanted = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text"))
    found = None
    for b in range(blocks):
        held = [tuple(r) for r in wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()]  # about block_bytes of text
        index = spark.sparkContext.broadcast(Index(held, words, edits))
        part = texts.mapInArrow(_scan(index), f"doc {kind}, item long, item_chars int, score int, exact_words boolean")
        if blocks > 1:
            part = cut(part)
            index.destroy()
        found = part if found is None else found.unionByName(part)
    return found.withColumnsRenamed({"doc": doc_id, "item": item_id})
