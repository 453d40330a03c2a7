import pytest

from tessera.llm.encodings import CYRILLIC, LOST, garbled, mend
from tests.llm.test_encodings import TEXTS

ZH, RU = "本实用新型涉及一种电机，", "Устройство по любому из пунктов, в котором клапан выполнен из материала сталь. "


@pytest.mark.parametrize("before, after", [(1, 0), (6, 0), (0, 1), (3, 3)])
def test_chinese_beside_garbled(before, after):
    wrong = garbled(TEXTS["zh"], "utf-8", "gb18030")
    alone = mend(wrong)[0]
    assert "发明" in alone and "夹具" in alone and alone.count(LOST) < 5
    assert mend(ZH * before + wrong + ZH * after) == (ZH * before + alone + ZH * after, ["utf-8>gb18030"])


def test_correct_chinese_between_garbled():
    wrong = garbled(TEXTS["zh"], "utf-8", "gb18030")
    assert mend(f"{wrong}电动机的密封件，{wrong}")[0] == f"{mend(wrong)[0]}电动机的密封件，{mend(wrong)[0]}"
    for line in (ZH, f"{ZH}{LOST}电动端盖，电机", "鐵路電機與鋼製鏈條"):
        assert mend(line) == (line, [])


@pytest.mark.parametrize("true, read", [p for p in CYRILLIC if p in (("cp1251", "cp1252"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"))])
def test_russian_beside_garbled(true, read):
    wrong = garbled(TEXTS["ru"], true, read)
    for before, after in ((1, 0), (4, 1), (0, 1)):
        assert mend(RU * before + wrong + " " + RU * after)[0] == RU * before + TEXTS["ru"] + " " + RU * after


def test_french_beside_garbled_russian():
    french = "Selon un mode préféré, le siège a été moulé. "
    assert mend(french + garbled(TEXTS["ru"], "cp1251", "cp1252"))[0] == french + TEXTS["ru"]
