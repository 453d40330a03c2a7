"""Only what is garbled changes: correct text and formulas beside it stay, damage on damage is undone to its end."""

import pytest

from tessera.llm.encodings import CYRILLIC, READ_AS, WESTERN, garbled, mend
from tests.llm.test_encodings import TEXTS

CORRECT = [
    "aΣb", "kΘ + bΩ", "The Γ function: 2Γx", "Φ = ΣxΔ", "ÄÖÜß", "Größe ÄÖÜß", "x = Σ a_i Δt", "αβγ δεζ", "Ω = 2π f", "10 µF ± 5 %", "2 × 3 × 4 mm", "width÷height", "Name│Wert│Zahl", "50 Ω/□",
    "Příliš žluťoučký kůň úpěl ďábelské ódy.", "Zażółć gęślą jaźń.", "Åse spiser rødgrød på Ærø’s kaj.", "¿Dónde está el niño? — «Aquí».", "L’été, « où çà » ?", "Ελληνικό κείμενο με τόνους.", "Українська мова і її слова.", "Съешь ещё этих мягких французских булок, да выпей чаю.",
    "これは正しい日本語です。", "한국어 문장입니다.", "Ça coûte 5 € à l'œil.", "İstanbul'da güneşli bir gün.",
]
RU = "Правильный русский текст здесь. "


@pytest.mark.parametrize("text", CORRECT)
def test_correct_text_stays(text):
    assert mend(text) == (text, [])


@pytest.mark.parametrize("text", CORRECT)
def test_correct_text_stays_beside_garbled(text):
    wrong = garbled("Die größere Öffnung führt das Gehäuse.", "utf-8", "cp1252")
    assert mend(f"{text} {wrong}")[0] == f"{text} Die größere Öffnung führt das Gehäuse."


@pytest.mark.parametrize("before", [RU, "Selon un mode préféré, le siège est à 57 °C où l'on l'étend. "])
@pytest.mark.parametrize("true, read", CYRILLIC)
def test_russian_beside_correct(before, true, read):
    assert mend(before + garbled(TEXTS["ru"], true, read)) == (before + TEXTS["ru"], [f"{true}>{read}"])


@pytest.mark.parametrize("times", [2, 3, 4, 5])
@pytest.mark.parametrize("read", READ_AS)
def test_damage_on_damage(read, times):
    for lang in ("de", "fr", "ru"):
        wrong = TEXTS[lang]
        for _ in range(times):
            wrong = garbled(wrong, "utf-8", read)
        assert mend(wrong)[0] == TEXTS[lang]


@pytest.mark.parametrize("true, read", [p for p in WESTERN if p[0] != "utf-8"])
def test_western_words(true, read):
    text = "Das größere Gehäuse führt über die kühlbare Fläche der Überprüfung."
    assert mend(garbled(text, true, read)) == (text, [f"{true}>{read}"])
    formula = "kΘ + bΩ = 2Γx, "
    assert mend(formula + garbled(text, true, read))[0].startswith(formula[:-2])


def test_two_pairs_in_a_line():
    a, b = TEXTS["fr"], TEXTS["ru"]
    assert mend(f"{garbled(a, 'utf-8', 'cp1252')} {garbled(b, 'koi8-r', 'cp1251')}")[0] == f"{a} {b}"
