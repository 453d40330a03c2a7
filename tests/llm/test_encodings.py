import pytest

from tessera.llm.encodings import garbled, mend, mend_text, wrongly_decoded

TEXTS = {
    "de": "Während des Betriebs führt das kühlbare Gehäuse größere Kräfte.",
    "fr": "Selon un mode de réalisation préféré, le siège est moulé à 57 °C.",
    "ru": "Устройство уплотнитель по любому из пунктов, в котором клапан выполнен из материала сталь.",
    "zh": "本发明公开了一种夹具，包括所述密封的轴承和所述可调的支架。",
    "en": "With a pitch of 49 µm – measured at the spindle – the “layer” stays intact.",
}


@pytest.mark.parametrize("read", ["cp1252", "latin-1", "cp1251", "cp437", "cp850", "mac_roman"])
@pytest.mark.parametrize("lang", TEXTS)
def test_utf8(lang, read):
    text = TEXTS[lang]
    assert mend(garbled(text, "utf-8", read)) == (text, [f"utf-8>{read}"]) or mend(garbled(text, "utf-8", read))[0] == text


def test_single_byte_pairs():
    for text, true, read in ((TEXTS["de"], "cp1252", "cp1251"), (TEXTS["ru"], "cp1251", "cp1252"), (TEXTS["ru"], "koi8-r", "cp1251"), (TEXTS["zh"], "gb18030", "latin-1")):
        assert mend(garbled(text, true, read))[0] == text


def test_twice_and_mixed():
    twice = garbled(garbled(TEXTS["fr"], "utf-8", "cp1252"), "utf-8", "cp1252")
    assert mend(twice)[0] == TEXTS["fr"]
    mixed = TEXTS["zh"] + " naïve " + garbled("größe", "utf-8", "cp1252")
    assert mend(mixed)[0] == TEXTS["zh"] + " naïve größe"


def test_no_case():
    for text in [*TEXTS.values(), "RESUMO DA INVENÇÃO", "ABRÉGÉ – ÉTÉ", "d = √(4A/π)", "η = 1 □ Q2/Q1", "the устройство of claim 1", "ФОРМУЛА ИЗОБРЕТЕНИЯ", "кВ·А", "a\xa0b", "", "«СССР»", "W = p?exp(?t/?)"]:
        assert mend(text)[1] == [], text
    assert mend_text("a\r\nb\nc")[0] == "a\r\nb\nc"


def test_lost_and_lines():
    assert mend_text("W�hrend\r\nok")[1:] == (["lost"], 1, True)
    text, pairs, lines, lossy = mend_text("ok é\r\nfÃ¼r\rx\n")
    assert (text, pairs, lines, lossy) == ("ok é\r\nfür\rx\n", ["utf-8>cp1252"], 1, False)


def test_frame(spark):
    df = spark.createDataFrame([(1, "fÃ¼r", 0), (1, "fÃ¼r", 0), (2, None, 0), (3, "", 0), (None, "fÃ¼r", 0), (4, "für " * 50000, 0)], "doc_id long, text string, restored int")
    got = sorted((r["doc_id"] or 0, r["restored"]) for r in wrongly_decoded(df, "doc_id", "text").collect())
    assert got == [(0, "für"), (1, "für"), (1, "für")]
    assert wrongly_decoded(df.limit(0), "doc_id", "text").count() == 0
