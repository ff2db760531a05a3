import json
import random

from murmurate.llm import copies

DDL = "row_id long, date string, `from` string, text string, canon string"


def records(spark, rows):
    return copies.canonical_records(spark.createDataFrame([(*r, "clash") for r in rows], DDL), "t", "row_id")


def test_dress_does_not_matter(spark):
    rows = [
        (3, "2005-06-15T10:50:00.000Z", "Bob", "Hello,  World 2!"), (1, "2005/06/15 10:50:00", " bob ", "hello world2"), (9, "2005-06-15T12:50:00+02:00", "BOB", "*HELLO*\nworld 2"),
        (4, "2005-06-15T10:50:01.000Z", "bob", "hello world2"), (5, "2005-06-15 10:50:00", "bobby", "hello world2"), (6, "2005-06-15 10:50:00", "bob", "hello world"),
        (7, "yesterday", "bob", "hello world2"), (8, "yesterday", "bob", "hello world2"), (10, "2005-06-15 10:50:00", None, "x"), (11, "2005-06-15 10:50:00", None, "x"),
        (12, "2005-06-15 10:50:00", "bob", "!!"), (13, "2005-06-15 10:50:00", "bob", " "), (14, "2005-06-15 10:50:00", "bob", None), (15, "2005-06-15 10:50:00", "b", "weiß"), (16, "2005-06-15 10:50:00", "b", "WEISS"),
    ]
    got = sorted((r.first_id, r.copy_id) for r in copies.copy_pairs(records(spark, rows)).collect())
    assert got == [(1, 3), (1, 9), (15, 16)]
    counts = {r.first_id: r.copies for r in copies.collapsed(records(spark, rows)).collect()}
    assert counts[1] == 3 and counts[7] == counts[8] == counts[14] == 1 and sum(counts.values()) == len(rows)


def test_hot_record_and_random_copies_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "2020-01-01 00:00:00", "hot", "Same" + "!" * rng.randrange(4)) for i in range(300)]
    rows += [(1000 + i, f"2020-01-01 00:00:0{rng.randrange(3)}", f"u{rng.randrange(3)}", f"{'a' * rng.randrange(3)} b{rng.randrange(4)}") for i in range(300)]
    rng.shuffle(rows)
    groups = {}
    for i, d, u, t in rows:
        groups.setdefault((d, u, "".join(c for c in t.lower() if c.isalnum())), []).append(i)
    want = sorted((min(g), i) for g in groups.values() for i in g if i != min(g))
    assert sorted((r.first_id, r.copy_id) for r in copies.copy_pairs(records(spark, rows)).collect()) == want


def test_layouts_of_payloads(spark):
    whole = {"date": "2020-01-01", "from": "Ann", "text": 'say "hi" = ok, \\ é\nnext'}
    esc = lambda v: v.replace("\\", "\\\\").replace('"', '\\"')
    good = [
        json.dumps(whole), json.dumps(whole, ensure_ascii=False, indent=1), json.dumps({k.upper(): v for k, v in reversed(whole.items())}),
        *[sep.join(f'{k}{eq}"{esc(v)}"' for k, v in order) for sep in (" ", ", ", "; ", " | ") for eq in ("=", ": ", " = ") for order in (list(whole.items()), list(whole.items())[::-1])],
    ]
    cut = json.dumps(whole)
    bad = [None, "", "  ", cut[:-1], cut[:30], 'from="a"; date="2020', 'from="a"; date="2020-01-01"', '{"date": "2020-01-01", "from": "a"}', "{}", "[1]"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(good + bad)], "i int, payload string")
    got = {r.i: (r["__date"], r["__from"], r["__text"]) for r in copies.with_payload_fields(df, "payload").collect()}
    for i in range(len(good)):
        assert got[i] == tuple(whole.values()), good[i]
    assert all(got[len(good) + i] == (None, None, None) for i in range(len(bad)))


def test_empty(spark):
    assert copies.copy_pairs(records(spark, [])).count() == 0 and copies.collapsed(records(spark, [])).count() == 0
