from murmurate.llm import language as L


def test_words_after_the_first_sixty_are_learned():
    long = " ".join(["the driver"] * 30 + ["zorped grawlix"] * 5)
    whole = L.fit([long, "ich habe den rechner"], ["en", "de"])
    cut = L.fit([" ".join(long.split()[:60]), "ich habe den rechner"], ["en", "de"])
    score = lambda m: m.marginals([m.lexicon.read(["zorped", "grawlix"])])[0][:, L.LANGUAGES.index("en")].min()
    assert score(whole) > score(cut) + 0.05
