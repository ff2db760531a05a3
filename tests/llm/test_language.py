import random

import numpy as np
from pyspark.sql import functions as F

from murmurate.llm import language as L

CLAUSES = {
    "en": ["the wireless driver stopped working after the update", "i would not touch the files until you have a copy", "what does the screen say when you run it"],
    "es": ["no puedo arrancar el equipo desde que cambié la tarjeta", "tienes que borrar la carpeta vieja antes de instalar", "me sale un mensaje raro cuando abro el programa"],
    "de": ["ich verstehe nicht warum der rechner jedes mal das passwort will", "mein bruder hat den gleichen drucker und bei ihm geht es", "du musst den alten ordner löschen bevor du installierst"],
    "ru": ["не могу запустить компьютер с тех пор как поменял карту", "сначала прочитай руководство и потом спрашивай", "выходит странное сообщение когда открываю программу"],
}


def training(n=400, noise=0.12, seed=0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        k = rng.choice(list(CLAUSES))
        t = ", ".join(rng.sample(CLAUSES[k], rng.choice([1, 2])))
        out.append((t, rng.choice(list(CLAUSES)) if rng.random() < noise else k))
    return out


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    emit, start, trans = rng.normal(size=(1, 3, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    paths = {(a, b, c): np.exp(start[a] + emit[0, 0, a] + trans[a, b] + emit[0, 1, b] + trans[b, c] + emit[0, 2, c]) for a in (0, 1) for b in (0, 1) for c in (0, 1)}
    z = sum(paths.values())
    m, moved, log_z = L.forward_backward(emit, np.array([3]), start, trans)
    assert abs(log_z[0] - np.log(z)) < 1e-12
    assert abs(m[0, 1, 1] - sum(v for k, v in paths.items() if k[1] == 1) / z) < 1e-12
    assert abs(moved[0, 1] - sum(v * ((k[0], k[1]) == (0, 1)) + v * ((k[1], k[2]) == (0, 1)) for k, v in paths.items()) / z) < 1e-12


def test_batches_of_any_length_agree():
    rng = np.random.default_rng(1)
    m = L.Crf(rng.normal(size=(L.BUCKETS, 8)), np.zeros(8), rng.normal(size=(8, 8)))
    s = [["a"] * n for n in (5, 1, 0, 9, 5)]
    for a, b in zip(m.marginals(s), m.marginals(s, cells=1)):
        assert a.shape == b.shape and np.allclose(a, b)


def test_noisy_labels_mixed_messages_and_borrowed_words(spark):
    model = L.fit(*zip(*training()), L.Lexicon(["release notes", "sound card"]))
    right = 0
    for t, k in [(c, k) for k, cs in CLAUSES.items() for c in cs]:
        words = [(m.group().lower(), *m.span()) for m in L._WORD.finditer(t)]
        right += {s[2] for s in L.stretches(t, words, model.marginals([[w for w, _, _ in words]])[0]) if s[4] >= 5} == {k}
    assert right >= 11
    rows = [
        (1, CLAUSES["de"][0] + " / " + CLAUSES["en"][1], "x"), (2, CLAUSES["es"][0] + ', gracias "please try again later"', "x"), (3, "ok thanks", "x"), (4, None, "x"), (5, "", "x"),
        (6, CLAUSES["ru"][2] + " release notes", "x"), (7, CLAUSES["en"][0], "x"), (8, CLAUSES["en"][0], "x"), (9, CLAUSES["de"][1], "x"), (10, (CLAUSES["en"][0] + ". ") * 3000, "x"),
    ]
    df = spark.createDataFrame(rows, "row_id long, text string, lang string")
    labels = spark.createDataFrame([(1, "de"), (2, None), (3, "en"), (4, "en"), (6, "RU-ru"), (7, "English"), (8, "fr"), (9, "klingon"), (10, "eng"), (77, "en"), (None, "en")], "row_id long, lang string")
    got = {(r.row_id, r.lang) for r in L.doubtful_labels(df, labels, model).collect()}
    assert got == {(1, "de"), (1, "en"), (2, "es"), (8, "en"), (9, "de")}
    seg = [r for r in L.segments(df, model).where("row_id = 1").orderBy("start_pos").collect()]
    assert [s.lang for s in seg] == ["de", "en"] and all(0.5 < s.confidence <= 1 for s in seg) and rows[0][1][seg[1].start_pos :].startswith("i would")
    best = {r.row_id: (r.lang, r.languages) for r in L.message_languages(L.segments(df, model)).collect()}
    assert best[1][1] == ["de", "en"] and best[3][1] == [] and set(best) == {1, 2, 3, 6, 7, 8, 9, 10}


def test_labels(spark):
    df = spark.createDataFrame([("EN",), ("en-US",), ("pt_BR",), ("Deutsch ",), ("und",), ("",), (None,), ("русский",)], "l string")
    assert [r[0] for r in df.select(L.label_language(F.col("l"))).collect()] == ["en", "en", "pt", "de", None, None, None, "ru"]


def test_nothing_to_learn_from(spark):
    model = L.fit([], [])
    assert L.segments(spark.createDataFrame([], "row_id long, text string"), model).count() == 0
