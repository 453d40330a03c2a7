import numpy as np
import pytest

from tessera.llm.mixing import VOCABULARY, language, measured, mixtures, one_spelling, rake


def test_rake():
    tokens = np.array([100.0, 300.0, 50.0, 50.0, 20.0])
    source = np.array([0, 0, 1, 1, 2])
    w = rake(tokens, source, np.array([200.0, 150.0, 90.0]), np.array([1.0, 4.0, 3.0]), [np.array([0, 1, 0, 1, 0])])
    got = np.bincount(source, tokens * w)
    assert np.allclose(got, [200, 150, 60]) and (w >= 0).all() and (w <= np.array([1, 1, 4, 4, 3]) + 1e-9).all()


def test_spelling(spark):
    df = spark.createDataFrame([(" Office-Alder ", "en-US"), ("office alder", "EN"), (None, None), ("", "  ")], "s string, l string")
    got = [tuple(r) for r in df.select(one_spelling(df["s"]), language(df["l"])).collect()]
    assert got == [("office_alder", "en"), ("office_alder", "en"), (None, "und"), (None, "und")]


def test_mixture(spark):
    rows = [(i, f"words and more words {i} " * (1 + i % 7), "big" if i % 10 else " Small", ["en", "de", None][i % 3], "x") for i in range(3000)]
    rows += [(9001, None, "big", "en", "x"), (9002, "", "big", "en", "x"), (9003, "unnamed", None, "en", "x"), (9004, "other " * 9, "other", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens string")
    sized = measured(docs, "doc_id", "text", "source", "lang").cache()
    total = sized.agg({"tokens": "sum"}).first()[0]
    targets = spark.createDataFrame([("r", "Big", 0.5, 1, 0.8), ("r", "small", 0.4, 2, 0.8), ("r", "nowhere", 0.1, 2, 0.8), ("s", "small", 1.0, 3, 0.25)], "run_name string, source string, target_share double, max_repeats int, size_factor double")
    draws, report, sides = mixtures(sized, targets)
    by = {(r["run_name"], r["source"]): r for r in report.collect()}
    assert by["r", "big"]["drawn_tokens"] == pytest.approx(0.4 * total, rel=0.01) and by["r", "big"]["shortfall_tokens"] < 0.01 * total
    assert by["r", "small"]["drawn_tokens"] == by["r", "small"]["available_tokens"] and by["r", "small"]["shortfall_tokens"] > 0
    assert by["r", "nowhere"]["drawn_tokens"] == 0 and by["r", "nowhere"]["shortfall_tokens"] == by["r", "nowhere"]["wanted_tokens"]
    assert by["s", "small"]["drawn_tokens"] == pytest.approx(0.25 * total, rel=0.03)
    uses = {(r["run_name"], r["id"]): r["uses"] for r in draws.collect()}
    assert all(n <= (1 if run == "r" and i % 10 else 3) for (run, i), n in uses.items()) and max(n for (run, _), n in uses.items() if run == "r") == 2
    assert not {9001, 9002, 9003, 9004} & {i for _, i in uses}
    shares = sides.collect()
    for run in ("r", "s"):
        for marginal in ("lang", "topic"):
            own = [r for r in shares if (r["run_name"], r["marginal"]) == (run, marginal)]
            for share in ("wanted_share", "raked_share", "drawn_share"):
                assert sum(r[share] for r in own) == pytest.approx(1, abs=1e-4)
            assert all(abs(r["raked_share"] - r["drawn_share"]) < 0.03 and r["moved"] < 1e-6 for r in own)
    assert all(abs(r["raked_share"] - r["wanted_share"]) < 1e-4 for r in shares if r["run_name"] == "s")
    draws, report, sides = mixtures(sized.limit(0), targets)
    assert sides.count() == 0
    assert draws.count() == 0 and report.agg({"drawn_tokens": "sum"}).first()[0] == 0


def test_tokens_are_the_tokenizers(spark):
    import base64

    import tiktoken

    from tessera.llm.mixing import PATTERN

    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    texts = ["Hello, world! 你好", "  ", "<|endoftext|>", "ß" * 5000]
    got = {r["id"]: r["tokens"] for r in measured(spark.createDataFrame([(i, t, "a", "en") for i, t in enumerate(texts)], "i int, t string, s string, l string"), "i", "t", "s", "l").collect()}
    encoding = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == {i: len(encoding.encode_ordinary(t)) for i, t in enumerate(texts)}
