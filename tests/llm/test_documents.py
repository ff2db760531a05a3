import math
import os
import random

import numpy as np
import pytest

from murmurate.llm import mixing, packing, reading, tokens

needs_tokenizer = pytest.mark.skipif(not os.path.exists(tokens.RANKS), reason="no tokenizer here")


def text(n):
    return " ".join(["word"] * n)


@needs_tokenizer
def test_token_counts(spark):
    df = spark.createDataFrame([(None,), ("",), ("hello world",), ("<|endoftext|>",), ("x" * 50_000,)], "text string")
    got = [r[0] for r in df.select(tokens.token_count(df.text)).collect()]
    assert got[:3] == [0, 0, 2] and got[3] > 1 and got[4] == tokens.count_tokens("x" * 50_000) > 1000


@pytest.mark.parametrize("seed", range(6))
def test_local_search_keeps_items_and_capacity(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, 90) for _ in range(rng.randrange(1, 120))]
    worst = [[i] for i in range(len(sizes))]
    for bins in (packing.pack(sizes, 100), packing.local_search(sizes, worst, 100)):
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
        assert len(bins) <= math.ceil(sum(sizes) / 100) * 1.25 + 1


def test_exchanges_empty_bins():
    # First fit leaves three bins; exchanging 60 for 50 fills one and makes room for the rest.
    sizes = [60, 30, 50, 40, 20]
    assert len(packing.local_search(sizes, [[0, 1], [2, 3], [4]], 100)) == 2
    assert packing.pack([], 10) == []


@needs_tokenizer
def test_packed_documents(spark):
    rng = random.Random(1)
    docs = [(i, text(rng.randrange(1, 60)), "c") for i in range(400)] + [(900, text(1000), "c"), (901, None, "c"), (902, "", "c"), (903, text(64), "c"), (903, text(64), "c"), (None, "x", "c")]
    out = packing.packed(spark.createDataFrame(docs, "doc_id long, text string, container string"), 64, shard_items=60).collect()
    load, pieces = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start_token, r.tokens))
        if r.container is not None:
            load[r.container] = load.get(r.container, 0) + r.tokens
    want = {i: tokens.count_tokens(t) for i, t, _ in docs if i is not None}
    assert {i: sum(p[2] for p in ps) for i, ps in pieces.items()} == want and max(load.values()) <= 64
    assert all(len(ps) == 1 for i, ps in pieces.items() if want[i] <= 64) and len(pieces[900]) == math.ceil(want[900] / 64)
    loose = [n % 64 for n in want.values() if n % 64]
    # Shards cost next to nothing against packing everything at once.
    assert len(load) <= 1.03 * len(packing.pack(loose, 64)) + sum(n // 64 for n in want.values()) + 1
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame(docs, "doc_id long, text string, container string"), 0)
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string"), 64).count() == 0


@needs_tokenizer
def test_mixture_meets_shares_to_the_token(spark):
    rng = random.Random(2)
    docs = [(i, text(rng.randrange(1, 40)), "big") for i in range(400)] + [(1000 + i, text(20), "small") for i in range(5)] + [(2000, "x", None), (2001, "x", "other"), (2002, None, "big")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumnRenamed("nothing", "x")
    targets = spark.createDataFrame([("big", 0.75, 1), ("small", 0.25, 3), ("absent", 0.0, 2)], "source string, target_share double, max_repeats int")
    used, budgets = mixing.mixture(df.repartition(7), targets, total_tokens=mixing.EXACT)
    rows = {r.source: r for r in mixing.shares(used, budgets).collect()}
    assert abs(rows["small"].actual_share - 0.25) < 1e-3 and rows["absent"].used_tokens == 0
    assert all(r.used_tokens == r.budget and r.most_uses <= r.max_repeats for r in rows.values())
    again = {tuple(r) for r in mixing.mixture(df.repartition(2), targets, total_tokens=mixing.EXACT)[0].collect()}
    assert again == {tuple(r) for r in used.collect()}
    fixed, b = mixing.mixture(df, targets, total_tokens=400)
    got = {r.source: r.used_tokens for r in mixing.shares(fixed, b).collect()}
    assert got["big"] == 300 and got["small"] == 100
    assert mixing.mixture(df.limit(0), targets)[0].count() == 0


def test_isotonic_is_the_best_monotone_fit():
    x, y = np.array([3.0, 1, 2, 4]), np.array([1.0, 2, 4, 5])
    xs, fit = reading.isotonic(x, y)
    assert list(xs) == [1, 2, 3, 4] and list(fit) == [2, 2.5, 2.5, 5]


EASY, HARD = "See the cat. It is red. Look at it go.", "Notwithstanding considerable methodological limitations, the investigation consequently demonstrates that heterogeneous representations accommodate interdependencies."


def test_ranker_orders_and_calibrates(spark):
    mid = "You can install the package with the tool, but restart the computer afterwards."
    docs = spark.createDataFrame([(i, [EASY, mid, HARD][i % 3] * (1 + i % 4), "s", "clash") for i in range(60)] + [(99, None, None, ""), (98, "  ", None, ""), (97, "123!", None, "")], "doc_id long, text string, source string, level string")
    labels = spark.createDataFrame([(i, "r", [1, 3, 5][i % 3]) for i in range(60)] + [(5000, "r", 3), (1, "r", None), (1, "r", 9)], "doc_id long, rater string, band int")
    got = {r.doc_id: r for r in reading.reading_levels(docs, labels).collect()}
    assert len(got) == 63 and sum(got[i].level == [1, 3, 5][i % 3] for i in range(60)) >= 55
    assert all(got[i].level == 1 and got[i].score is None for i in (97, 98, 99))
    none = reading.reading_levels(docs, labels.limit(0)).collect()
    assert {r.level for r in none} == {1}
    assert reading.reading_levels(docs.limit(0), labels).count() == 0


def test_raters_scales_cancel_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(reading.FEATURES)))
    true = x[:, 0] * 2 - x[:, 3]
    rater = np.where(np.arange(400) % 2 == 0, "mild", "strict")
    band = np.clip(np.round(3 + true / 2 + np.where(rater == "strict", 1, -1)), 1, 5).astype(int)
    m = reading.fit_ranker(x, band, rater)
    fresh = rng.normal(size=(500, len(reading.FEATURES)))
    assert np.corrcoef(m.scores(fresh), fresh[:, 0] * 2 - fresh[:, 3])[0, 1] > 0.97


def test_features_by_hand_and_of_odd_texts():
    r = reading.FeatureReader(["the", "was"])
    text = "The rule was broken, because nations differ. Well-known?"
    got = dict(zip(("words", *reading.FEATURES), r.read([None, text, "", "x" * 300_000, "12 !?"])[1]))
    words = ["the", "rule", "was", "broken", "because", "nations", "differ", "well", "known"]
    assert got["words"] == 9 and abs(got["word_length"] - sum(map(len, words)) / 9) < 1e-12
    assert got["passives"] == got["subordination"] == got["compounds"] == got["abstract_endings"] == 1 / 9 and got["questions"] == 0.5
    assert got["long_words"] == 2 / 9 and abs(got["beyond_100"] - 7 / 9) < 1e-12 and abs(got["sentence_length"] - np.log1p(4.5)) < 1e-12
    odd = r.read([None, "", "12 !?", text, "x" * 300_000, ""])
    assert (odd[[0, 1, 5], 1:] == 0).all() and odd[2, 0] == 0 and odd[4, 0] == 1 and (odd[3] == r.read([text])[0]).all()
    assert r.read([]).shape[0] == 0


def test_every_pair_of_a_rater_is_used():
    band, rater = np.array([1, 2, 3, 1, 5, 2]), np.array(list("aaabba"))
    want = {(i, j) for i in range(6) for j in range(6) if rater[i] == rater[j] and band[i] > band[j]}
    for block in (1, 3, 10_000):
        reading.PAIR_BLOCK, kept = block, reading.PAIR_BLOCK
        assert sum(len(a) for a, _ in reading._pairs(band, rater)) == len(want)
        assert {p for a, b in reading._pairs(band, rater) for p in zip(a.tolist(), b.tolist())} == want
        reading.PAIR_BLOCK = kept
