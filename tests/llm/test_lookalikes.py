import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.lookalikes import LOOKALIKES, Trie, canonical_texts, lookalike_pairs, table_form

SAME = [
    ("film", "ｆｉｌｍ"), ("café", "café"), ("café", "cаfе́"), ("a b", "a b"), ("a b", "a　b"), ("mm", "m​m"), ("ậ", "ậ"), ("ậ", "ậ"),
    ("é", "e‍́"), ("手", "⼿"), ("soft", "so­ft"), (",", "，"), ("Kobe", "Κobe"), ("2", "２"), ("ox", "οх"),
]
OTHER = [("film", "Film"), ("cafe", "café"), ("m2", "m²"), ("è", "é"), ("a b", "ab"), ("l", "1"), ("O", "0"), ("。", "."), ("a", "b"), ("a!", "a")]


def test_table():
    for a, b in SAME:
        assert table_form(a) == table_form(b), (a, b)
    for a, b in OTHER:
        assert table_form(a) != table_form(b), (a, b)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_table_is_stable(text):
    once = table_form(text)
    assert table_form(once) == once
    assert table_form(unicodedata.normalize("NFD", text)) == once


def test_automaton():
    t = Trie()
    for w, n in (("lens", 5), ("lense", 1), ("café", 3), ("оса", 9)):
        t.add(w, n)
    assert t.canonical("lеn​s") == "lens"
    assert t.canonical("café") == "café"
    assert t.canonical("cafe") is None
    assert t.canonical("oca") == "оса"
    assert t.canonical("lenz") is None and t.canonical("lenz", 1) == "lens"
    assert t.canonical("ens", 1) == "lens" and t.canonical("lenns", 1) == "lens"
    assert len(set(LOOKALIKES.values()) & set(LOOKALIKES)) == 0


def test_forms(spark):
    texts = [a for p in SAME for a in p] + ["", "​", None, "film", "x" * 30000 + "е", "оса оса здесь", "осa"]
    df = spark.createDataFrame([(t, 1) for t in texts], "p string, canonical int")
    got = {r["text"]: r["canonical"] for r in canonical_texts(df, "p").collect()}
    assert set(got) == {t for t in texts if t is not None}
    for a, b in SAME:
        assert got[a] == got[b], (a, b)
    assert got[""] == got["​"] == "" and got["x" * 30000 + "е"] == "x" * 30000 + "e"
    assert got["оса оса здесь"] == "оса оса здесь" and got["осa"] == "оса"
    assert canonical_texts(df.limit(0), "p").count() == 0


def test_pairs(spark):
    rows = [("t1", "film"), ("t2", "ｆilm"), ("t3", "film"), ("t4", "Film"), ("t1", "film"), ("t5", None), (None, "fi​lm"), ("t2", "film")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "task_id string, raw_prompt string, form string")
    got = sorted(tuple(r) for r in lookalike_pairs(df, "task_id", "raw_prompt").collect())
    assert got == [("t1", "t2"), ("t2", "t3")]


def test_hot_text(spark):
    df = spark.range(3000).selectExpr("concat('t', lpad(id, 5, '0')) task_id", "case when id % 3 = 0 then 'one hot text' when id = 1 then 'one hоt text' else concat('text ', id) end raw_prompt")
    pairs = lookalike_pairs(df, "task_id", "raw_prompt")
    assert pairs.count() == 1000 and pairs.where("task_id_a = 't00001' or task_id_b = 't00001'").count() == 1000
