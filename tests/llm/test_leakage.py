import random
import re

from tessera.llm import leakage
from tessera.llm.leakage import Index, leaked_items

random.seed(7)
VOCAB = ["".join(random.choices("abcdefghijklmnop", k=random.randint(2, 9))) for _ in range(60)]


def words(n):
    return random.choices(VOCAB, k=n)


def brute(docs, items, n=12):
    grams = lambda t: {tuple(w[i : i + n]) for w in [re.findall(r"[^\W_]+", t.lower())] for i in range(len(w) - n + 1)}
    held = {i: grams(t) for i, t in items}
    return {(d, i) for d, t in docs if t for g in [grams(t)] for i in held if g & held[i]}


def corpus():
    items = [(i, " ".join(words(random.randint(11, 50)))) for i in range(40)]
    docs = []
    for d in range(300):
        w = words(random.randint(0, 120))
        if d % 3 == 0:
            src = random.choice(items)[1].split()
            n = random.choice([10, 11, 12, 13, len(src)])
            at = random.randint(0, max(0, len(src) - n))
            cut = src[at : at + n]
            if d % 2:
                cut = [x.upper() for x in cut]
            k = random.randint(0, len(w))
            w[k:k] = cut
        docs.append((d, random.choice([" ", ", ", "\r\n", " -- ", "_"]).join(w)))
    return docs, items


def test_against_brute_force():
    docs, items = corpus()
    index = Index(items)
    got = {(docs[d][0], i) for d, i, _, _, exact in index.leaks([t for _, t in docs]) if exact}
    assert got == brute(docs, items) and len(got) > 20


def test_long_texts_are_cut_without_loss(monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(leakage, "SEGMENT", 300)
    index = Index(items)
    long = [(0, " ".join(t for _, t in docs)), (1, ""), (2, docs[0][1])]
    got = {(long[d][0], i) for d, i, _, _, exact in index.leaks([t for _, t in long]) if exact}
    assert got == brute(long, items)


def test_small_edits():
    _, items = corpus()
    item = next(t for _, t in items if len(t.split()) > 20)
    edited = item.replace(item.split()[6], item.split()[6] + "x", 1)
    assert [x[1] for x in Index([(5, item)]).leaks([" ".join(words(30)) + " " + edited])] == [5]


def test_frame(spark):
    docs, items = corpus()
    rows = [(d, t, 0) for d, t in docs] + [(900, None, 0), (901, "", 0), (None, items[0][1] * 3, 0), (902, "é " * 100000 + items[-1][1], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item long")
    held = spark.createDataFrame([(i, t, "x") for i, t in items] + [(None, "a", "x"), (77, None, "x")], "item_id long, text string, doc string")
    want = brute(docs, items) | {(902, i) for _, i in brute([(902, items[-1][1])], items)}
    for block in (leakage.BLOCK_BYTES, 2000):
        got = leaked_items(df, "doc_id", "text", held, "item_id", "text", block_bytes=block)
        assert {(r["doc_id"], r["item_id"]) for r in got.where("exact_words and doc_id is not null").collect()} == want
    assert leaked_items(df.limit(0), "doc_id", "text", held, "item_id", "text").count() == 0
    assert leaked_items(df, "doc_id", "text", held.limit(0), "item_id", "text").count() == 0


def test_index_is_small():
    items = [(i, " ".join("".join(random.choices("abcdefghijklmnop", k=random.randint(2, 9))) for _ in range(400))) for i in range(600)]
    index = Index(items)
    size = sum(len(t) for _, t in items)
    assert (index.size() - (4 << 20)) / size < 11.5


def test_common_grams_are_counted_in_pieces(monkeypatch):
    docs, items = corpus()
    want = Index(items).leaks([t for _, t in docs])
    monkeypatch.setattr(leakage, "MATCHES", 5)
    assert Index(items).leaks([t for _, t in docs]) == want


def test_recall_of_one_edit():
    """Stretches of 12 words and more with one character put in, left out or replaced."""
    found = n = 0
    for trial in range(400):
        item = " ".join(words(40))
        src = item.split()
        at, size = random.randint(0, 20), random.choice([12, 13, 15, 20])
        cut = " ".join(src[at : at + size])
        k = random.randrange(len(cut))
        cut = random.choice([cut[:k] + "z" + cut[k:], cut[:k] + cut[k + 1 :], cut[:k] + "z" + cut[k + 1 :]])
        doc = " ".join([*words(30), cut, *words(30)])
        n += 1
        found += any(i == 5 for _, i, *_ in Index([(5, item)]).leaks([doc]))
    assert found >= 0.98 * n
