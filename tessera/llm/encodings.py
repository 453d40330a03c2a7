"""Text decoded with the wrong character encoding: found by precomputed garbled sequences, restored span by span.

For every pair (true encoding, encoding it was read in) the sequences that characters turn into are computed once
and put into one multi-pattern automaton. A line's matches decide which pair damaged it, span by span; only the matched
spans are put back through that pair, so correct text beside them stays as it is. Damage on damage is undone layer by layer, until
nothing matches any more.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ship

# Single-byte encodings that UTF-8 is commonly read in, and the bytes cp1252 and cp1250/cp1251 leave undefined.
READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "mac_roman", "koi8-r")
# Western and Cyrillic single-byte pairs (true, read as).
WESTERN = (("cp1252", "cp1251"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("utf-8", "gb18030"))
CYRILLIC = (("cp1251", "cp1252"), ("koi8-r", "cp1252"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("cp866", "cp1251"), ("cp1251", "cp866"))
# Letters of Western languages that single-byte pairs are looked for in, words of one of them, and signs that stand beside or between words in correct text.
ACCENTED = "äöüßÄÖÜéèêëàâáãåçíìîïñóòôõúùûøæœÉÈÀÂÇÊÎÔÑÓÕÁÃÍÚ"
WORDS_OF_ONE = set("àéèóáêôíÀÉÈÓÁÊÔÍ")
EDGES = set("•–—’'‘“”…«»")
JOINERS = EDGES | set("÷×·±°/§")
# Letters of Russian, those that are words, and frequent pairs of them.
RUSSIAN, ALONE = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "абвжикосуя"
BIGRAMS = "ст но то на ен ов ни ра во ко по не ро пр го ал ре ел ос ли та ва де ка ло ер ть ол ор ле ла ет те ог ом ес ат од ан из об ны ти ия ий"
# Quotes, dashes and blanks that may follow a letter in correct text, and letters or signs that may follow the garbled lead.
MAY_FOLLOW = set("\xa0\xad«»“”„‘’‚‹›–—…•") | set("ёЁπ∑∫∂Ω∞")
# Chinese marks that tell restored text; what a change between correct and garbled words must gain in letter pairs.
MARKS = "，。、：“”"
TURN = 2
HOMOGLYPHS = set("аеорсухіјѕАВЕКМНОРСТХІЈЅ")

LOST = "�"
_GAP = "\x1a"
_ASCII = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = re.compile("(\r\n|\r|\n)")
_LATIN_RUN = re.compile("[\xa1-\xff]+")
_HAN = re.compile("[一-鿿]")
_LATIN_FOUR = re.compile("[\xa1-\xff]{4}")
_CYRILLIC_RUN = re.compile("[Ѐ-џ]+")
_RUSSIAN = ("russian", "")


def _sources() -> list[str]:
    """Characters that texts in question hold, and all that the encodings read bytes as: damage on damage is made of these."""
    spans = ((0x80, 0x180), (0x2C6, 0x2C7), (0x2DC, 0x2DD), (0x386, 0x3CF), (0x400, 0x460), (0x490, 0x492), (0x1D62, 0x1D6B), (0x1E9E, 0x1E9F), (0x2010, 0x2027), (0x2030, 0x203B), (0x2070, 0x209D), (0x20AC, 0x20AD), (0x2100, 0x2127), (0x2190, 0x21D5), (0x2200, 0x2270), (0x25A0, 0x25A2), (0x3000, 0x3020), (0x3041, 0x30FF), (0x4E00, 0xA000), (0xFF01, 0xFF5F), (0xFEFF, 0xFF00))
    read = (c for e in READ_AS for c in _reading(e) if c > "\x7f")
    return list(dict.fromkeys([*(chr(c) for a, b in spans for c in range(a, b)), *read]))


@lru_cache(maxsize=None)
def _reading(encoding: str) -> tuple[str, ...]:
    """What each byte becomes; bytes without a meaning pass as control characters, as lenient readers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return tuple(out)


@lru_cache(maxsize=None)
def _writing(encoding: str) -> dict[str, int]:
    return {c: b for b, c in reversed(list(enumerate(_reading(encoding))))}


def garbled(text: str, true: str, read: str) -> str:
    """``text`` written in ``true`` and read in ``read``."""
    raw = text.encode(true)
    return raw.decode(read, "replace") if read == "gb18030" else "".join(_reading(read)[b] for b in raw)


def restored(text: str, true: str, read: str, lossy: bool = False) -> str | None:
    """The inverse of ``garbled``; None where it isn't possible."""
    try:
        if read != "gb18030":
            return bytes(_writing(read)[c] for c in text).decode(true)
        if not lossy:
            return text.encode(read).decode(true)
    except (KeyError, UnicodeError):
        return None
    # a replacement character stands for lost bytes, which also spoil the character they were part of
    raw = text.replace(LOST, _GAP).encode(read, "replace")
    return re.sub(f"{LOST}*{_GAP}{LOST}*", LOST, raw.decode(true, "replace"))


def _natural_case(word: str) -> bool:
    return word.islower() or word.isupper() or (word[0].isupper() and word[1:].islower())


def _build() -> ahocorasick.Automaton:
    found: dict[str, list] = defaultdict(list)
    for read in READ_AS:
        letters_only = read in ("cp866", "koi8-r")
        for c in _sources():
            seq = garbled(c, "utf-8", read)
            tail = set(seq[1:])
            # the leads of these two are letters of Russian: a sequence of letters alone is no evidence
            weak = tail <= MAY_FOLLOW or (letters_only and seq.isalpha()) or (len(seq) == 2 and seq[0] in "–—‚„") or (read == "cp1251" and seq == "В·") or (read == "koi8-r" and tail <= set("°²·÷©≈≤≥√ё"))
            found[seq].append(("utf-8", read, weak))
    for true, read in WESTERN:
        for g, c in _accented(true, read).items():
            latin = g.isalpha() and g < "Ͱ"
            if g in "’'ʼ·-–—‑…" or (latin and not (g.isupper() and c.islower())):
                continue
            for a in _ASCII:
                if latin and not a.islower():
                    continue  # a capital within small letters is what tells
                weak = g in HOMOGLYPHS or not (g.isalpha() or g == "\x81")
                found[a + g].append((true, read, weak))
                if g.isalpha() and not latin:
                    found[g + a].append((true, read, weak))
    for hi in range(0xB0, 0xF8):
        for lo in range(0xA1, 0xFF):
            found[chr(hi) + chr(lo)].append(("gb18030", "latin-1", False))
    for c in "，。、：；（）？！“”《》":
        found[garbled(c, "gb18030", "latin-1")].append(("gb18030", "latin-1", False))
    for true, read in CYRILLIC:
        for b in BIGRAMS.split():
            for form in (b, b.upper(), b.capitalize()):
                found[garbled(form, true, read)].append((true, read, False))
    for b in BIGRAMS.split():
        for form in (b, b.upper(), b.capitalize()):
            found[form].append((*_RUSSIAN, False))
    for hi in range(0xE4, 0xEA):
        for lo in range(0x80, 0xC0):
            g = bytes([hi, lo]).decode("gb18030", "ignore")
            if g:
                found[g].append(("utf-8", "gb18030", False))
    automaton = ahocorasick.Automaton()
    for seq, pairs in found.items():
        automaton.add_word(seq, (len(seq), tuple(pairs)))
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=None)
def _accented(true: str, read: str) -> dict[str, str]:
    """What accented letters turn into, where that is one visible character."""
    pairs = ((garbled(c, true, read), c) for c in ACCENTED if _can(c, true))
    return {g: c for g, c in pairs if len(g) == 1 and not g.isspace()}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    return _build()


def _spans(hits: list[tuple[int, int, bool]]) -> list[tuple[int, int, int, bool]]:
    """Chains of adjoining sequences: begin, end, how many, whether one is strong."""
    out: list[list] = []
    for begin, end, weak in sorted(hits):
        if out and begin < out[-1][1]:
            continue
        if out and begin == out[-1][1]:
            out[-1][1:] = [end, out[-1][2] + 1, out[-1][3] or not weak]
        else:
            out.append([begin, end, 1, not weak])
    return [tuple(x) for x in out]


Mended = tuple[str, int] | None  # the line and how many strange characters the pair explains


def _replace(line: str, spans: Iterable[tuple[int, int]], true: str, read: str) -> Mended:
    out, at, explained = [], 0, 0
    for begin, end in spans:
        good = restored(line[begin:end], true, read)
        if good is not None:
            out += [line[at:begin], good]
            at = end
            explained += sum(c > "\x7f" for c in line[begin:end])
    return ("".join([*out, line[at:]]), explained) if explained else None


def _utf8(line: str, hits: list, read: str) -> Mended:
    spans = _spans(hits)
    if read == "cp866":  # Chinese may turn into small letters alone, which any Russian word may hold
        spans = [s for s in spans if s[3] or not line[s[0] : s[1]].islower()]
    mixed = lambda b, e: ((b and line[b - 1] in _ASCII) or (e < len(line) and line[e] in _ASCII)) and any(c.isalpha() and c >= "Ͱ" for c in line[b:e])
    sure = any(s[3] or s[2] >= 3 or mixed(s[0], s[1]) for s in spans)
    return _replace(line, [s[:2] for s in spans], "utf-8", read) if sure else None


def _gbk_as_latin(line: str) -> Mended:
    if not _LATIN_FOUR.search(line):
        return None
    good = []
    for b, e in (m.span() for m in _LATIN_RUN.finditer(line)):
        text = restored(line[b:e], "gb18030", "latin-1") if (e - b) % 2 == 0 else None
        if not text or not all("一" <= c <= "鿿" or c in "，。、：；（）？！“”《》·—…°±×" or "！" <= c <= "～" for c in text):
            continue
        # accented letters may stand side by side: few characters must all be frequent ones
        han = [c for c in text if "一" <= c <= "鿿"]
        if sum(map(_common, han)) >= (0.75 if len(han) >= 4 else 1) * len(han):
            good.append((b, e))
    return _replace(line, good, "gb18030", "latin-1") if any(e - b >= 4 for b, e in good) else None


@lru_cache(maxsize=None)
def _cyrillic_words(true: str, read: str) -> tuple[re.Pattern, dict[int, str]]:
    """Runs of the characters that Russian letters turn into (in a Cyrillic page with its letters, as correct words are made of them), and the letters by these."""
    letters = {garbled(c, true, read): c for c in RUSSIAN + RUSSIAN.upper()}
    own = re.escape("".join(letters))
    return re.compile(f"[{own}]+" if read == "cp1252" else f"[{own}Ѐ-џ]+"), {ord(g): c for g, c in letters.items()}


class _Counts:
    """Sequences found within a stretch of the line."""

    def __init__(self, hits: list[tuple[int, int, bool]]) -> None:
        self.begins, self.ends = sorted(h[0] for h in hits), sorted(h[1] for h in hits)

    def within(self, begin: int, end: int) -> int:
        return max(0, bisect_right(self.ends, end) - bisect_left(self.begins, begin))


def _case_fault(word: str) -> bool:
    return len(word) >= 3 and not _natural_case(word)


def _garbled_runs(line: str, found: _Counts, russian: _Counts, true: str, read: str) -> list[list[tuple[int, int]]]:
    """Neighbouring words that read better put back than as they stand: two states, and changing between them costs ``TURN``."""
    script, letters = _cyrillic_words(true, read)
    words = [m.span() for m in script.finditer(line)]
    gains = []
    for b, e in words:
        word = line[b:e]
        back = word.translate(letters)
        within_latin = read == "cp1252" and ((b and line[b - 1] in _ASCII) or (e < len(line) and line[e] in _ASCII))
        number = word in "×÷" and (line[:b].rstrip()[-1:].isdigit() or line[e:].lstrip()[:1].isdigit())
        if within_latin or number or not all(ord(c) in letters for c in word):
            gains.append(-1 if within_latin or number else -max(1, len(word)))
            continue
        stands = 0 if read == "cp1252" else russian.within(b, e) - _case_fault(word)
        gains.append(found.within(b, e) - _case_fault(back) - stands)
    if not any(g > 0 for g in gains):
        return []
    correct, wrong, steps = 0, 0, []
    for gain in gains:
        steps.append((wrong - TURN > correct, correct - TURN > wrong))
        correct, wrong = max(correct, wrong - TURN), max(wrong, correct - TURN) + gain
    runs: list[list[tuple[int, int]]] = []
    state, joined = wrong > correct, False
    for span, (from_wrong, from_correct) in zip(reversed(words), reversed(steps), strict=True):
        if state:
            if joined:
                runs[-1].append(span)
            else:
                runs.append([span])
        joined, state = state, not from_correct if state else from_wrong
        joined = joined and state
    return [r[::-1] for r in runs[::-1]]


def _cyrillic(line: str, hits: list, plain: list, true: str, read: str) -> Mended:
    """Words that become Russian by the pair; each run of them is judged by itself."""
    found, russian = _Counts(hits), _Counts(plain)
    letters = _cyrillic_words(true, read)[1]
    good = []
    for run in _garbled_runs(line, found, russian, true, read):
        run = [(b, e) for b, e in run if all(ord(c) in letters for c in line[b:e]) and (e - b > 1 or line[b].isalpha() or letters[ord(line[b])].lower() in ALONE)]
        long = [(b, e) for b, e in run if e - b >= 3]
        size, back = sum(e - b for b, e in long), sum(found.within(b, e) for b, e in long)
        stands = sum(russian.within(b, e) for b, e in long)
        if size < 5 or back < 0.15 * size or (read != "cp1252" and (stands >= 0.2 * size or back <= 2 * stands)):
            continue
        if sum(_natural_case(line[b:e].translate(letters)) for b, e in long) >= 0.8 * len(long):
            good += run
    return _replace(line, good, true, read)


@lru_cache(maxsize=1)
def _gbk_chain() -> re.Pattern:
    """Characters that UTF-8 turns into when read as GB18030, one after the other: a character of two bytes holds the first two of three bytes
    (lead), the last and the next first (turn), or the last two (rest); lost bytes may stand for any of them. ASCII joins them."""
    by: dict[str, list[str]] = defaultdict(list)
    following = {0xE2: range(0x80, 0xA0), 0xE3: range(0x80, 0x84), **{b: range(0x80, 0xC0) for b in range(0xE4, 0xEA)}, 0xEF: range(0xBC, 0xBE)}
    for hi in range(0x81, 0xFF):
        for lo in range(0x40, 0xFF):
            c = bytes([hi, lo]).decode("gb18030", "ignore")
            if len(c) != 1:
                continue
            if lo in following.get(hi, ()):
                by["lead"].append(c)
            elif hi < 0xC0 and lo in following:
                by["turn"].append(c)
            elif hi < 0xC0 and 0x80 <= lo < 0xC0:
                by["rest"].append(c)
            elif hi < 0xC0 and lo < 0x7F:
                by["ascii"].append(c)  # the last byte and a Latin letter
    lead, turn, rest, swallowed = (f"[{re.escape(''.join(by[k]))}]" for k in ("lead", "turn", "rest", "ascii"))
    rare = lambda k: f"[{re.escape(''.join(c for c in by[k] if not _common(c) and c not in MARKS))}]"
    gone, sign = f"(?:{LOST}+|[?])", "[" + "".join(garbled(c, "utf-8", "gb18030") for c in "°±·×÷µμΩπα") + "]"
    # after lost bytes correct text may follow, common characters of which could pass for the last two of a sequence
    after = f"{gone}(?:{turn}{gone})*(?:{rare('turn')}{rest}|{turn}{rare('rest')}|{turn}{rest}(?={lead}|{gone}|[\x00-\x7f]|$)|{swallowed}|{rest}(?={lead}))?"
    core = f"(?:{lead}(?:{turn}(?:{rest}|{after})|{swallowed}|{after})|{after}|{sign}(?={lead}|{LOST}|[\x00-\x7f]|$))"
    return re.compile(f"{core}(?:[\x00-\x7f]*{core})*+")


def _common(c: str) -> bool:
    """One of the frequent Chinese characters (level 1 of GB 2312)."""
    raw = c.encode("gb2312", "ignore")
    return len(raw) == 2 and 0xB0 <= raw[0] <= 0xD7


def _utf8_as_gbk(line: str) -> Mended:
    """Each chain of garbled characters is put back and judged by itself; what lies between is kept."""
    whole = restored(line, "utf-8", "gb18030")
    spans = [m.span() for m in _gbk_chain().finditer(line)] if whole is None else [(0, len(line))]
    all_han = len(_HAN.findall(line))
    out, at, explained = [], 0, 0
    for b, e in spans:
        own = line[b:e]
        text, han = restored(own, "utf-8", "gb18030", lossy=True), len(_HAN.findall(own))
        good = sum("一" <= c <= "鿿" or c in MARKS for c in text)
        bad = text.count(LOST) + text.count("?") - own.count("?")
        # few characters beside correct ones may fit by chance
        sure = han == all_han or good >= 4 or all(map(_common, _HAN.findall(text)))
        if good >= 2 and good > bad and good >= 0.3 * han and sure:
            out += [line[at:b], text]
            at = e
            explained += sum(c > "\x7f" for c in own)
    return ("".join([*out, line[at:]]), explained) if explained else None


@lru_cache(maxsize=None)
def _western_word(true: str, read: str) -> re.Pattern:
    return re.compile("[A-Za-zÀ-ÖØ-öø-ÿ" + re.escape("".join(_accented(true, read))) + "]+")


def _western(line: str, hits: list, true: str, read: str) -> Mended:
    """Foreign characters within Latin words. A word is evidence if sequences are found in it, it has three plain letters and reads naturally put back;
    a character at its edge, or a sign that may join words, needs a second word. Then words with two plain letters and words of one letter are put back too."""
    letters = _accented(true, read)
    strong, weak = {b for b, _, w in hits if not w} | {e - 1 for _, e, w in hits if not w}, {e - 1 for _, e, _ in hits}
    sure: set[str] = set()
    half: set[str] = set()
    words = []
    for m in _western_word(true, read).finditer(line):
        b, e = m.span()
        odd = [k for k in range(b, e) if line[k] in letters]
        while odd and odd[-1] == e - 1 and line[e - 1] in EDGES:  # closes a quotation, or a sentence
            odd.pop()
            e -= 1
        while odd and odd[0] == b and line[b] in EDGES:
            odd.pop(0)
            b += 1
        if not odd:
            continue
        word = line[b:e]
        back = "".join(letters.get(c, c) for c in word)
        plain = sum(c in _ASCII for c in word)
        natural = _natural_case(back)
        words.append((b, e, odd, plain, natural, back))
        if plain < (2 if read == "gb18030" else 3) or not natural:
            continue
        inner = [k for k in odd if b < k < e - 1]
        if any(k in strong or (k in weak and line[k] not in JOINERS and not line[k].isalpha()) for k in inner):
            sure.add(word)
        elif any(k in weak or k in strong for k in odd):
            half.add(word)
    if not sure and len(half) < 2:
        return None
    spans = []
    for b, e, odd, plain, natural, back in words:
        before, after = line[:b].rstrip()[-1:], line[e:].lstrip()[:1]
        calm = not {before, after} & set("=+<>")  # no formula
        alone = calm and back in WORDS_OF_ONE and (back in "àÀ" or (after.isalpha() and not before.isdigit()))
        short = calm and plain == 1 and natural and not before.isdigit() and (len(back) == 2 or len(odd) >= 2)
        if alone or short or (natural and plain >= 2):
            spans += [(k, k + 1) for k in odd]
    return _replace(line, spans, true, read)


def _can(c: str, encoding: str) -> bool:
    try:
        c.encode(encoding)
    except UnicodeError:
        return False
    return True


def mend(line: str) -> tuple[str, list[str]]:
    """A line restored as far as possible and the pairs ``true>read`` that damaged it; no pairs: nothing is wrong."""
    pairs: list[str] = []
    seen = {line}
    while not line.isascii():
        by: dict[tuple[str, str], list] = defaultdict(list)
        for last, (size, of) in automaton().iter(line):
            for true, read, weak in of:
                by[true, read].append((last + 1 - size, last + 1, weak))
        russian = by.pop(_RUSSIAN, [])
        best: tuple[tuple[int, bool], str, str] | None = None
        for (true, read), hits in by.items():
            if (true, read) == ("utf-8", "gb18030"):
                latin = [h for h in hits if line[h[0]] in _ASCII or line[h[1] - 1] in _ASCII]
                good = (_utf8_as_gbk(line) if len(hits) > len(latin) else None) or (_western(line, latin, true, read) if latin else None)
            elif true == "utf-8":
                good = _utf8(line, hits, read)
            elif true == "gb18030":
                good = _gbk_as_latin(line)
            elif (true, read) in WESTERN:
                good = _western(line, hits, true, read)
            else:
                good = _cyrillic(line, hits, russian, true, read)
            if good is not None and good[0] not in seen:
                # what explains most strange characters; control characters left over speak against a pair
                gain = good[1] - 3 * sum("\x80" <= c < "\xa0" for c in good[0]), true == "utf-8"
                if best is None or gain > best[0]:
                    best = (gain, good[0], f"{true}>{read}")
        if best is None:
            break
        # UTF-8 undone makes the line shorter; other pairs never bring back a line seen before
        line, pairs = best[1], [*pairs, best[2]]
        seen.add(line)
    return line, pairs


def mend_text(text: str) -> tuple[str, list[str], int, bool]:
    """Restored text, the pairs found, the number of damaged lines, whether any characters are lost for good."""
    if text.isascii():
        return text, [], 0, False
    parts, pairs, damaged, lost = _BREAK.split(text), [], 0, False
    for i in range(0, len(parts), 2):
        line = parts[i]
        if line.isascii():
            continue
        gone = LOST in line
        parts[i], found = mend(line)
        if gone and not found:
            found = ["lost"]
        lost = lost or gone or LOST in parts[i]
        damaged += bool(found)
        pairs += [p for p in found if p not in pairs]
    return "".join(parts), pairs, damaged, lost


def _mend_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows, done = [], []
        for i, text in enumerate(texts):
            if text is not None:
                fixed = mend_text(text)
                if fixed[2]:
                    rows.append(i)
                    done.append(fixed)
        if rows:
            columns = [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.list_(pa.string()), pa.int32(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), *columns], names=["id", "restored", "encodings", "damaged_lines", "lossy"])


def wrongly_decoded(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows with at least one line decoded in a wrong encoding: ``<id>, restored, encodings, damaged_lines, lossy``.

    ``restored`` is the whole text with the damaged spans put right and everything else, line ends included, as it was;
    ``encodings`` names the pairs ``true>read`` (``lost``: replacement characters alone, which can't be restored);
    ``lossy`` tells that characters are lost for good. Null and empty texts are no case; ids may be null or repeated, a row is
    judged by itself; other columns are ignored.
    """
    ship(df.sparkSession)
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = rows.mapInArrow(_mend_batches, f"id {kind}, restored string, encodings array<string>, damaged_lines int, lossy boolean")
    return found.withColumnRenamed("id", id_column)
