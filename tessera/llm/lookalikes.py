"""Text that looks the same but differs in its characters, brought to one form.

The distinct tokens of the corpus are its vocabulary. Words are cut into one part more than the budget of edits, of which one is always
left whole: by it words and tokens meet in blocks, with one trie of clean spellings each. A weighted edit automaton walks the trie for every token that is not plain ASCII,
with no cost for look-alikes and for characters without width, and a cost of 1 for any other edit. Of the words reached
within the budget (0: only what looks the same) the best spelling is canonical, and texts take it from there. Tokens that reach none,
and what stands between tokens, are brought into form by table.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, shuffle_partitions

# Letters and signs of other scripts and blocks that look identical to the one they map to.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ѵ": "V", "Ӏ": "I",
    # Greek
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian, Latin, Coptic
    "օ": "o", "Օ": "O", "ո": "n", "հ": "h", "ս": "u", "զ": "q", "Տ": "S", "Լ": "L", "ɡ": "g", "ɑ": "a", "ⲟ": "o", "Ⲟ": "O", "ⲣ": "p", "Ⲣ": "P", "ⲥ": "c", "Ⲥ": "C", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
    # Cherokee, Lisu
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # Katakana like Chinese characters and Hiragana
    "ニ": "二", "ロ": "口", "カ": "力", "ト": "卜", "ハ": "八", "エ": "工", "タ": "夕", "ヘ": "へ",
    # signs
    "‐": "-", "‑": "-", "−": "-", "﹣": "-", "∕": "/", "⁄": "/", "∶": ":", "‧": "·", "∙": "·", "⋅": "·", "ʼ": "’", "ʹ": "′", "µ": "μ", "∑": "Σ", "∏": "Π", "∆": "Δ",
    # radicals of Chinese characters without a decomposition of their own
    "⺠": "民", "⻄": "西", "⻅": "见", "⻆": "角", "⻋": "车", "⻓": "长", "⻔": "门", "⻘": "青", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻨": "麦", "⻩": "黄", "⻬": "齐", "⻮": "齿", "⻰": "龙", "⻳": "龟",
}

_SCRIPTS = {s: regex.compile(rf"\p{{{s}}}") for s in ("Latin", "Cyrillic", "Greek", "Armenian", "Coptic", "Cherokee", "Lisu", "Hiragana", "Katakana", "Hangul", "Arabic", "Hebrew", "Thai", "Devanagari")}


@lru_cache(maxsize=1 << 16)
def ignorable(ch: str) -> bool:
    """Has no width: format characters, variation selectors, the grapheme joiner."""
    return unicodedata.category(ch) == "Cf" or ch in "͏᠋᠌᠍" or "︀" <= ch <= "️" or "\U000e0100" <= ch <= "\U000e01ef"


@lru_cache(maxsize=1 << 16)
def plain(ch: str) -> str:
    """The character as it is usually written: any blank a space, no width or presentation variant. Superscripts, subscripts, fractions, circled and squared forms stay; so do multi-letter signs other than ligatures and Roman numbers."""
    if unicodedata.category(ch) == "Zs" or ch == "\t":
        return " "
    if ch in "  \x85":
        return "\n"
    kind, _, code = unicodedata.decomposition(ch).partition(" ")
    if kind in ("<wide>", "<narrow>", "<font>", "<vertical>", "<isolated>", "<initial>", "<medial>", "<final>") and " " not in code:
        return plain(chr(int(code, 16)))
    if kind == "<compat>" and ch != "ſ" and (" " not in code or "ﬀ" <= ch <= "ﬆ" or "Ⅰ" <= ch <= "ⅿ"):
        return unicodedata.normalize("NFKC", ch)
    return ch


class _Table(dict):
    """For str.translate: every character's table form, found once."""

    def __init__(self, letters: bool) -> None:
        super().__init__()
        self.letters = letters

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        out = "" if ignorable(ch) else plain(ch)
        if self.letters:
            out = "".join(LOOKALIKES.get(x, x) for x in out)
        self[code] = out
        return out


class _Bare(dict):
    """For str.translate: leaves out what has no width."""

    def __missing__(self, code: int) -> int | None:
        self[code] = out = None if ignorable(chr(code)) else code
        return out


_SHAPES, _WIDTHS, _BARE = _Table(True), _Table(False), _Bare()


_KANA = {ord(b): a for a, b in LOOKALIKES.items() if "ァ" <= a <= "ヺ"}
_HAS_KANA = re.compile("[ァ-ヺ]").search
_KANA_RUN = regex.compile("[ァ-ー" + "".join(map(chr, _KANA)) + "]*[ァ-ヺ][ァ-ー" + "".join(map(chr, _KANA)) + "]*")


def _in_kana(text: str) -> str:
    """Shapes that are both Katakana and another script are Katakana where they stand beside other Katakana."""
    return _KANA_RUN.sub(lambda m: m[0].translate(_KANA), text) if _HAS_KANA(text) else text


#: Characters met so far: those that are in form wherever they stand, and the others.
_STAYS: set[str] = set()
_CHANGES: set[str] = set()


def _stays(ch: str) -> bool:
    """Is in form, and neither a mark nor part of a syllable that could be composed with its neighbours."""
    jamo = "\u1100" <= ch <= "\u11ff"
    return _SHAPES[ord(ch)] == ch and not unicodedata.decomposition(ch) and unicodedata.category(ch)[0] not in "MC" and not jamo and unicodedata.normalize("NFD", ch) == ch


def table_form(text: str) -> str:
    """``text`` in one form by table alone: what looks the same comes out equal."""
    if text.isascii():
        return text.replace("\t", " ")
    held = set(text)
    for c in held - _STAYS - _CHANGES:
        (_STAYS if _stays(c) else _CHANGES).add(c)
    if held.isdisjoint(_CHANGES):
        return _in_kana(text)
    bare = unicodedata.normalize("NFD", text.translate(_BARE))
    # what looks like Katakana gets the other script's character first, so that both spellings come to one
    return _in_kana(unicodedata.normalize("NFC", unicodedata.normalize("NFD", bare.translate(_SHAPES))))


_IN_TOKEN = r"[\p{L}\p{M}\p{Nd}\p{Cf}]--[\p{Han}]"


def _torn() -> str:
    """Letters that look like a sign: no part of a token, or the texts would be parted differently."""
    held = regex.compile(f"[{_IN_TOKEN}]", regex.V1).match
    shapes = {b for a, b in LOOKALIKES.items() if bool(held(a)) != bool(held(b))}
    spans = ((0xA0, 0x3100), (0xF900, 0x10000), (0x1D400, 0x1D800))
    return "".join(c for a, b in spans for c in map(chr, range(a, b)) if held(c) and table_form(c) in shapes)


TOKEN = regex.compile(f"[{_IN_TOKEN}--[{_torn()}]]+", regex.V1)


#: Texts without a character of this kind hold no token but plain ASCII (a pattern of the JVM).
_ODD = r"[\p{L}\p{M}\p{Nd}\p{Cf}&&[^\p{IsHan}]&&[^\x00-\x7F]]"


@lru_cache(maxsize=1 << 16)
def _script(ch: str) -> str | None:
    return next((s for s, p in _SCRIPTS.items() if p.match(ch)), None) if ch.isalpha() else None


def clean(token: str) -> bool:
    """A spelling fit for the vocabulary: composed, nothing without width, no presentation forms, letters of one script."""
    return token.isascii() or (unicodedata.normalize("NFC", token) == token == token.translate(_WIDTHS) and len({_script(c) for c in token} - {None}) <= 1)


def units(token: str) -> str:
    """What the automaton reads: decomposed characters in plain width; those without width stay, but for ones beside a mark (they would hide the marks' order)."""
    wide = "".join(c if ignorable(c) else plain(c) for c in token)
    out = unicodedata.normalize("NFD", wide)
    if any(ignorable(a) and unicodedata.combining(b) for a, b in zip(out, out[1:], strict=False)):
        out = unicodedata.normalize("NFD", "".join(c for c in wide if not ignorable(c)))
    return out


class Trie:
    """Vocabulary words by their units; an edge carries the unit, edges of a node are grouped by look-alike class."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, count: int) -> None:
        node = self.root
        for u in units(word):
            node = node.setdefault(LOOKALIKES.get(u, u), {}).setdefault(u, {})
        node.setdefault("", []).append((word, count))

    def reach(self, token: str, budget: int = 0) -> dict[str, tuple[int, int]]:
        """Words reached within the budget: their least cost and their count."""
        states = self._inserted([(0, self.root)], budget)
        for u in units(token):
            if ignorable(u):
                continue  # deleting it costs nothing
            shape, after = LOOKALIKES.get(u, u), {}
            for cost, node in states:
                for child in node.get(shape, {}).values():
                    self._keep(after, cost, child)
                if cost < budget:
                    self._keep(after, cost + 1, node)
                    for other, group in node.items():
                        if other and other != shape:
                            for child in group.values():
                                self._keep(after, cost + 1, child)
            states = self._inserted(list(after.values()), budget)
            if not states:
                return {}
        found: dict[str, tuple[int, int]] = {}
        for cost, node in states:
            for word, count in node.get("", ()):
                if word not in found or cost < found[word][0]:
                    found[word] = (cost, count)
        return found

    @staticmethod
    def _keep(states: dict, cost: int, node: dict) -> None:
        if id(node) not in states or cost < states[id(node)][0]:
            states[id(node)] = (cost, node)

    @classmethod
    def _inserted(cls, states: list, budget: int) -> list:
        if not budget:
            return states
        best = {id(n): (c, n) for c, n in states}
        queue = list(best.values())
        while queue:
            cost, node = queue.pop()
            if cost < budget:
                for shape, group in node.items():
                    for child in group.values() if shape else ():
                        if id(child) not in best or cost + 1 < best[id(child)][0]:
                            best[id(child)] = (cost + 1, child)
                            queue.append((cost + 1, child))
        return list(best.values())

    def best(self, token: str, budget: int = 0) -> tuple[int, bool, int, str] | None:
        """The best spelling reached, as ``(cost, not ASCII, -count, word)``: least cost, plain ASCII first, then the most frequent, then the smallest; None if none is reached."""
        found = self.reach(token, budget)
        return min((cost, not w.isascii(), -n, w) for w, (cost, n) in found.items()) if found else None

    def canonical(self, token: str, budget: int = 0) -> str | None:
        found = self.best(token, budget)
        return found[-1] if found else None


def _parts(size: int, budget: int) -> list[tuple[int, int]]:
    return [(i * size // (budget + 1), (i + 1) * size // (budget + 1)) for i in range(budget + 1)]


def word_keys(word: str, budget: int) -> set[str]:
    """Blocks of a vocabulary word: its length, and one of budget + 1 parts of its table form. An edit changes one unit, so a part stays whole."""
    u = unicodedata.normalize("NFD", table_form(word))
    return {f"{len(u)} {i} {u[a:b]}" for i, (a, b) in enumerate(_parts(len(u), budget))}


def token_keys(token: str, budget: int) -> set[str]:
    """All blocks that may hold a word within the budget: parts of words of any length in reach, at most the budget off their places."""
    u = unicodedata.normalize("NFD", table_form(token))
    keys = set()
    for size in range(max(0, len(u) - budget), len(u) + budget + 1):
        for i, (a, b) in enumerate(_parts(size, budget)):
            keys |= {f"{size} {i} {u[a + k : b + k]}" for k in range(-budget, budget + 1) if a + k >= 0 and b + k <= len(u)}
    return keys


def _vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(TOKEN.findall(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])


def _blocks(budget: int):
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for token, n in zip(batch.column("token").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if clean(token):
                    rows += [(k, token, n, True) for k in word_keys(token, budget)]
                if not token.isascii():
                    rows += [(k, token, n, False) for k in token_keys(token, budget)]
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.bool_()), strict=True)], names=["block", "token", "n", "word"])

    return blocks


WALKED = "token string, cost int, foreign boolean, rank long, canonical string"


def _walk(budget: int):
    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, trie = None, [], None
        for batch in batches:
            out = []
            for b, token, n, is_word in zip(*(batch.column(c).to_pylist() for c in ("block", "token", "n", "word")), strict=True):
                if b != block:
                    block, words, trie = b, [], None
                if is_word:
                    words.append((token, n))
                    continue
                if trie is None:
                    trie = Trie()
                    for w in words:
                        trie.add(*w)
                best = trie.best(token, budget)
                if best is not None:
                    out.append((token, *best))
            columns = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string()), strict=True)], names=["token", "cost", "foreign", "rank", "canonical"])

    return walk


def spellings(texts: DataFrame, column: str, budget: int = 0) -> DataFrame:
    """``token, canonical``: the spelling that the automaton finds for each token that isn't plain ASCII; tokens that reach no clean spelling are left out."""
    counted = texts.select(column).where(F.col(column).isNotNull()).mapInArrow(_vocabulary, "token string, n long")
    words = counted.groupBy("token").agg(F.sum("n").alias("n"))
    placed = words.mapInArrow(_blocks(budget), "block string, token string, n long, word boolean").repartition(shuffle_partitions(texts.sparkSession), "block")
    walked = placed.sortWithinPartitions("block", F.col("word").desc(), "token").mapInArrow(_walk(budget), WALKED)
    if not budget:  # then a token meets its words in one block
        return walked.select("token", "canonical")
    return walked.groupBy("token").agg(F.min(F.struct("cost", "foreign", "rank", "canonical")).alias("best")).select("token", "best.canonical")


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, tokens = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = {t for t in TOKEN.findall(text) if not t.isascii()}
            keys += [key] * len(own)
            tokens += own
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(tokens, pa.string())], names=["text_key", "token"])


def rewritten(text: str, words: dict[str, str]) -> str:
    """``text`` with the tokens in ``words`` replaced by their spelling there and the rest in table form."""
    if not words:
        return table_form(text)
    out, at = [], 0
    for m in TOKEN.finditer(text):
        if m[0] in words:
            out += [table_form(text[at : m.start()]), words[m[0]]]
            at = m.end()
    return _in_kana("".join([*out, table_form(text[at:])]))


def _rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, words = batch.column("text").to_pylist(), batch.column("words").to_pylist()
        done = [rewritten(t, dict(w) if w else {}) for t, w in zip(texts, words, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("text"), pa.array(done, pa.string())], names=["text", "canonical"])


def canonical_texts(df: DataFrame, column: str, budget: int = 0) -> DataFrame:
    """``text, canonical``: every distinct text of ``column`` and its one consistent form.

    Texts that look the same to a reader have equal forms: width of letters, composition of accents, characters
    without width, the kind of blank and the script or block of an identical-looking letter or sign don't count. Letter case,
    accents, raised digits and everything else visible stay. Nulls are left out, an empty text stays empty,
    a text of characters without width becomes empty; repeated rows give one row; other columns are ignored. With a
    ``budget`` above 0 tokens also take the spelling of words that many visible edits away.
    """
    texts = cut(df.select(F.col(column).alias("text")).where("text IS NOT NULL").distinct())
    found = cut(spellings(texts, "text", budget)).hint("merge")  # grows with the vocabulary: never broadcast
    schema = "text string, canonical string"
    odd = F.rlike("text", F.lit(_ODD))
    plainly = texts.where(~odd).withColumn("words", F.lit(None).cast("map<string,string>"))
    keyed = texts.where(odd).withColumn("text_key", F.sha2("text", 256))
    held = keyed.select("text_key", "text").mapInArrow(_tokens, "text_key string, token string").join(found, "token")
    words = held.groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("token", "canonical"))).alias("words"))
    return plainly.unionByName(keyed.join(words, "text_key", "left").select("text", "words")).mapInArrow(_rewrite, schema)


def lookalike_classes(df: DataFrame, key: str, column: str) -> DataFrame:
    """``<key>, class_id, links``: the keys whose texts look like another key's but aren't the same string, a row per key and class; ``class_id`` is the digest of the
    common form, ``links`` the number of keys in the class that a pair of different spellings ties to this one. Linear in the rows, however large a class. Nulls are left out, repeated rows count once."""
    digest = lambda c: F.sha2(F.col(c), 256)
    forms = canonical_texts(df, column).select(digest("text").alias("spelling"), digest("canonical").alias("class_id"))
    rows = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("k"), digest(column).alias("spelling")).distinct()
    own = cut(rows.join(forms, "spelling").groupBy("class_id", "k").agg(F.count("*").alias("n"), F.min("spelling").alias("spelling")))
    whole = own.groupBy("class_id").agg(F.count("*").alias("keys"))
    # a key of one spelling is tied to all but those that have this one alone; a key of several to all
    same = own.where("n = 1").groupBy("class_id", "spelling").agg(F.count("*").alias("alike"))
    tied = own.join(whole, "class_id").join(same, ["class_id", "spelling"], "left")
    links = F.when(F.col("n") > 1, F.col("keys") - 1).otherwise(F.col("keys") - F.col("alike"))
    return tied.select(F.col("k").alias(key), "class_id", links.alias("links")).where("links > 0")


def lookalike_pairs(df: DataFrame, key: str, column: str) -> DataFrame:
    """``<key>_a, <key>_b``: two keys (a < b) with a row each whose texts look the same but aren't the same string."""
    digest = lambda c: F.unhex(F.sha2(F.col(c), 256))
    # from here on texts are their digests: only the search for distinct texts moves texts themselves
    forms = cut(canonical_texts(df, column).select(digest("text").alias("spelling"), digest("canonical").alias("form")))
    several = forms.groupBy("form").agg(F.count("*").alias("n")).where("n > 1").select("form")
    spelt = forms.join(several, "form")
    rows = cut(df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("k"), digest(column).alias("spelling")).join(spelt, "spelling").select("k", "form", "spelling").distinct())
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col("a.form") == F.col("b.form")) & (F.col("a.k") < F.col("b.k")) & (F.col("a.spelling") != F.col("b.spelling")))
    return pairs.select(F.col("a.k").alias(f"{key}_a"), F.col("b.k").alias(f"{key}_b")).distinct()
