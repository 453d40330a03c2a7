from tessera.llm.leakage import Index


def test_exact_words_after_a_better_stretch():
    long = [f"extraordinarily{chr(97 + k)}long" for k in range(11)]
    middle = [f"middleword{chr(97 + k)}" for k in range(8)]
    other = [f"unlikethis{chr(110 + k)}" for k in range(8)]
    late = [f"w{chr(97 + k)}" for k in range(12)]
    index = Index([(7, " ".join(long + middle + late))])
    held = index.leaks(["before it " + " ".join(long + other + late) + " and after"])
    assert [(d, i, exact) for d, i, _, _, exact in held] == [(0, 7, True)]
    cut = index.leaks(["before it " + " ".join(long + other + late[:11]) + " and after"])
    assert not any(exact for *_, exact in cut)
