import random

from murmurate.llm import conversations as c

DDL = "row_id long, folder long, dialogue_id string, date string, `from` string, `to` string, text string, reason string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], DDL)


def brute(rows):
    out = {}
    for f, d, date, who, to, text in rows:
        if f is not None and d is not None:
            out.setdefault((f, int(d.split(".")[0])), []).append((date, (who or "").strip().lower(), (to or "").strip().lower(), (text or "").strip()))
    got = set()
    for k, ms in out.items():
        ms = [m for m in ms if m[3]]
        senders = {m[1] for m in ms if m[1]}
        lost = any(not m[1] and not (len(senders) == 2 and m[2] in senders) for m in ms)
        if not ms:
            got.add((*k, "empty"))
        elif any(not m[0] or not m[0][0].isdigit() for m in ms) or lost:
            got.add((*k, "broken"))
        elif len(senders) < 2:
            got.add((*k, "no_reply"))
    return got


def test_verdicts_match_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(900):
        d = rng.randrange(80)
        date = rng.choice([f"20{rng.randrange(10, 16)}-0{rng.randrange(1, 9)}-01 00:00:00"] * 40 + ["", None, "yesterday"])
        who = rng.choice([f"u{d % 3}", f"U{d % 3 + 1} ", f"u{rng.randrange(3) if d % 5 == 0 else d % 3}"] * 10 + [None, " "])
        rows.append((d % 4, f"{d}.tsv", date, who, rng.choice([f"u{d % 3}", f"u{d % 3 + 1}", "x", None]), rng.choice(["hi"] * 20 + ["", None, "  "])))
    rows += [(7, "1.tsv", "2012-01-01", "a", None, t) for t in ("", None)] + [(None, "1", "2012-01-01", "a", None, "x"), (1, None, "2012-01-01", "a", None, "x")]
    got = {tuple(r) for r in c.left_out(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_a_dialogue_far_apart_in_time_is_one(spark):
    rows = [(1, "5.tsv", "2004-01-01 00:00:00", "a", None, "q"), (1, "5", "2016-01-01 00:00:00", "b", None, "r"), (1, "6", "2010-01-01", "a", None, "q"), (2, "5", "9999-12-31 00:00:00", "a", None, "q")]
    assert {tuple(r) for r in c.left_out(frame(spark, rows)).collect()} == {(1, 6, "no_reply"), (2, 5, "no_reply")}


def test_order_roles_and_inferred_senders(spark):
    rows = [
        (1, "5.tsv", "2010-01-01 00:02:00", None, "Ann", "third"), (1, "5.tsv", "2010-01-01 00:00:00", "Ann", None, "first"), (1, "5.tsv", "2010-01-01 00:01:00", "bob", None, "second"),
        (1, "5.tsv", "2010-01-01 00:01:00", "bob", None, "second"), (1, "5.tsv", "bad", "bob", None, " "), (2, "5.tsv", "2010-01-01", "x", None, "alone"),
    ]
    got = sorted((r.folder, r.turn, r.row_id, r.speaker, r.role) for r in c.conversations(frame(spark, rows)).collect())
    assert got == [(1, 0, 1, "ann", "asker"), (1, 1, 2, "bob", "helper"), (1, 2, 3, "bob", "helper"), (1, 3, 0, "bob", "helper")]


def test_empty(spark):
    assert c.left_out(frame(spark, [])).count() == 0


def test_really_late_rows_and_long_dialogues_are_whole(spark):
    """Three arrivals in no order of time, so rows come years behind the watermark; and dialogues of many parts."""
    rng = random.Random(9)
    rows = []
    for i in range(600):
        d = rng.choice([1, 1, 1, 2, 3, 4 + i % 30])
        rows.append((0, f"{d}.tsv", f"20{rng.randrange(10, 16)}-0{rng.randrange(1, 9)}-0{rng.randrange(1, 9)} 00:00:{rng.randrange(10, 60)}", rng.choice(["a", "b"] if d != 3 else ["a"]), rng.choice(["a", "b"]), "hi"))
        if d == 2 and i % 5 == 0:
            rows[-1] = (*rows[-1][:3], None, *rows[-1][4:])
    from pyspark.sql import functions as F

    df = frame(spark, rows).withColumn("came", F.expr("row_id % 3"))
    expected = brute(rows)
    for options in ({"arrival": "came"}, {"part_rows": 40}, {"arrival": "came", "part_rows": 40}, {}):
        assert {tuple(r) for r in c.left_out(df, **options).collect()} == expected
        got = {}
        for r in c.conversations(df, **options).collect():
            got.setdefault(r.dialogue, []).append((r.turn, r.row_id, r.speaker, r.role))
        assert len(got[1]) == sum(r[1] == "1.tsv" for r in rows)
        for d, turns in got.items():
            own = sorted((r[2], i, r[3] or ("b" if r[4] == "a" else "a")) for i, r in enumerate(rows) if r[1] == f"{d}.tsv")
            assert sorted(turns) == [(n, i, who, "asker" if who == own[0][2] else "helper") for n, (_, i, who) in enumerate(own)]
