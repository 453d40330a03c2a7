"""Spellings come from the automaton: without it the canonical texts differ."""

import pytest

from tessera.llm import lookalikes
from tessera.llm.lookalikes import Trie, canonical_texts, lookalike_classes, lookalike_pairs, spellings, table_form, token_keys, word_keys

TEXTS = ["оса летит", "осa летит", "lens cap", "lеns cap", "ꓡens", "роса", "pоca", "中口ボット", "中ロボット", "ｌｅｎｓ cap", "x−y", "x-y"]


def test_spellings_are_the_automatons(spark):
    found = {r["token"]: r["canonical"] for r in spellings(spark.createDataFrame([(t,) for t in TEXTS], "p string"), "p").collect()}
    assert (found["осa"], found["оса"], found["lеns"], found["ｌｅｎｓ"], found["роса"], found["pоca"]) == ("оса", "оса", "lens", "lens", "роса", "роса")
    assert "ꓡens" not in found  # no clean word looks like it


def test_forms_without_the_automaton_differ(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in TEXTS], "p string")
    forms = {r["text"]: r["canonical"] for r in canonical_texts(df, "p").collect()}
    assert forms["осa летит"] == forms["оса летит"] == "оса летит" and forms["pоca"] == forms["роса"] == "роса"
    assert forms["中口ボット"] == forms["中ロボット"] == "中ロボット" and forms["x−y"] == forms["x-y"] and forms["ꓡens"] == "Lens"
    assert any(forms[t] != table_form(t) for t in TEXTS)
    blind = spark.createDataFrame([], "token string, canonical string")
    monkeypatch.setattr(lookalikes, "spellings", lambda *a: blind)
    assert forms != {r["text"]: r["canonical"] for r in canonical_texts(df, "p").collect()}


@pytest.mark.parametrize("budget", [0, 1, 2])
def test_words_within_the_budget_share_a_block(budget):
    words = ["lens", "camera", "оса", "naïve", "window", "a", ""]
    letters = "abеéx"
    for word in words:
        near = {word}
        for _ in range(budget):
            near |= {w[:k] + x + w[k + d :] for w in near for k in range(len(w) + 1) for d in (0, 1) for x in ("", *letters)}
        t = Trie()
        t.add(word, 1)
        for token in near:
            if t.reach(token, budget):
                assert word_keys(word, budget) & token_keys(token, budget), (word, token)


def test_budget_reaches_the_first_letters(spark):
    df = spark.createDataFrame([("camera lens",), ("xаmera lens",), ("cаmerа",), ("çamera",)], "p string")
    forms = {r["text"]: r["canonical"] for r in canonical_texts(df, "p", 1).collect()}
    assert forms["xаmera lens"] == "camera lens" and forms["cаmerа"] == "camera"


def test_classes_agree_with_pairs(spark):
    rows = [("t1", "film"), ("t2", "ｆilm"), ("t3", "film"), ("t4", "Film"), ("t1", "film"), ("t5", None), (None, "fi​lm"), ("t2", "film"), ("t6", "fіlm"), ("t7", "оne")]
    df = spark.createDataFrame(rows, "task_id string, raw_prompt string")
    links = {}
    for r in lookalike_pairs(df, "task_id", "raw_prompt").collect():
        for k in r:
            links[k] = links.get(k, 0) + 1
    assert {r["task_id"]: r["links"] for r in lookalike_classes(df, "task_id", "raw_prompt").collect()} == links
    assert lookalike_classes(df.limit(0), "task_id", "raw_prompt").count() == 0
