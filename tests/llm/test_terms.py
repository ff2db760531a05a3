import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from murmurate.llm import terms


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcé", max_size=6)), st.integers(1, 5))
def test_trie_counts_like_a_counter(words, burst):
    t = terms.BurstTrie(burst)
    for w in words:
        t.add(w, 1, 2)
    got = {p + rest: tuple(c) for p, leaf in t.subtrees() for rest, c in leaf.items()}
    assert got == {w: (n, 2 * n) for w, n in Counter(words).items()} and t.size == len(got)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id long, words array<string>, term string")
    counts, total = terms.term_frequencies(df.repartition(4), key="id", fields={"words": "words"}, **kw)
    return {(r.field_name, r.term): (r.occurrences, r.records) for r in counts.collect()}, total


def test_counts_match_brute_force_with_tiny_limits(spark):
    rng = random.Random(2)
    words = ["Hot"] * 40 + [f"{'ab'[i % 2] * (i % 5)}{i}" for i in range(60)] + ["", "Éa", "éA"]
    rows = [(i, [rng.choice(words) for _ in range(rng.randrange(9))], "clash") for i in range(300)]
    occ, rec = Counter(), Counter()
    for _, ws, _ in rows:
        occ.update(w.lower() for w in ws)
        rec.update({w.lower() for w in ws})
    got, total = run(spark, rows + rows[:50], burst=3, flush=20, routes=8, routing_sample=30)
    assert total == 300 and got == {("words", w): (n, rec[w]) for w, n in occ.items()}


def test_nulls_and_empty(spark):
    got, total = run(spark, [(1, None, ""), (2, [], ""), (3, [None, "A", "a"], ""), (None, ["a"], "")])
    assert total == 3 and got == {("words", "a"): (2, 1)}
    assert run(spark, []) == ({}, 0)


def test_marks(spark):
    c = spark.createDataFrame([("f", "r", 9, 2), ("f", "m", 9, 3), ("f", "c", 9, 21)], "field_name string, term string, occurrences long, records long")
    assert {r.term: r.mark for r in terms.mark_terms(c, 1000).collect()} == {"r": "rare", "m": None, "c": "common"}
    assert {r.term: r.mark for r in terms.mark_terms(c, 1050).collect()}["c"] is None
