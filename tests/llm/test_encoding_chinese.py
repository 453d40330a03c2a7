import pytest

from tessera.llm.encodings import garbled, mend
from tests.llm.test_encodings import TEXTS


@pytest.mark.parametrize("read", ["cp866", "koi8-r"])
def test_chinese_in_cyrillic_pages(read):
    wrong = garbled(TEXTS["zh"], "utf-8", read)
    assert mend(wrong) == (TEXTS["zh"], [f"utf-8>{read}"])
    russian = "чем шагал чайник, шаг и цель, число щек. "
    assert mend(russian + wrong) == (russian + TEXTS["zh"], [f"utf-8>{read}"])
    assert mend(russian) == (russian, [])
