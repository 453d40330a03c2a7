import pytest

from tessera.llm.lookalikes import TOKEN, canonical_texts, lookalike_pairs, table_form


@pytest.mark.parametrize("letter, sign", [("donʼt", "don’t"), ("5ʹ a", "5′ a"), ("xʹy", "x′y"), ("Σον ov", "∑ον ov")])
def test_letter_like_a_sign(spark, letter, sign):
    df = spark.createDataFrame([("a", letter), ("b", sign)], "task_id string, raw_prompt string")
    forms = {r["text"]: r["canonical"] for r in canonical_texts(df, "raw_prompt").collect()}
    assert forms[letter] == forms[sign]
    assert [tuple(r) for r in lookalike_pairs(df, "task_id", "raw_prompt").collect()] == [("a", "b")]


def test_other_letters_stay_in_tokens():
    assert TOKEN.findall("naïve слово αβγ mµ a​b") == ["naïve", "слово", "αβγ", "mµ", "a​b"]
    assert table_form("ʼ") == "’"
