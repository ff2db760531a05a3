import random
from datetime import datetime, timedelta

from murmurate.operators.sessions import user_sessions

START = datetime(2020, 1, 1)


def brute(rows, gap=30 * 60):
    seen, users = set(), {}
    for i, u, d in rows:
        if i is None or i in seen or d is None or not (u or "").strip():
            continue
        seen.add(i)
        users.setdefault(u.strip().lower(), []).append((d, i))
    out = []
    for u, events in users.items():
        events.sort()
        run = [events[0]]
        for e in events[1:]:
            if (e[0] - run[-1][0]).total_seconds() > gap:
                out.append((u, run[0][0], run[-1][0], len(run), run[0][1], run[-1][1]))
                run = []
            run.append(e)
        out.append((u, run[0][0], run[-1][0], len(run), run[0][1], run[-1][1]))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, None if d is None else d.strftime("%Y-%m-%d %H:%M:%S.%f"), "x") for i, u, d in rows], "message_id long, `from` string, date string, slot string")
    got = user_sessions(df, **kw).collect()
    return sorted((r.user_name, r.session_start, r.session_end, r.event_count, r.first_event_id, r.last_event_id) for r in got)


def test_gap_of_exactly_the_limit_does_not_split(spark):
    rows = [(1, "a", START), (2, "A ", START + timedelta(minutes=30)), (3, "a", START + timedelta(minutes=60, microseconds=1))]
    assert run(spark, rows) == brute(rows)
    assert len(run(spark, rows)) == 2


def test_long_chain_and_random_users_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "busy", START + timedelta(minutes=17 * i)) for i in range(300)]
    rows += [(1000 + i, f"u{rng.randrange(7)}", START + timedelta(seconds=rng.randrange(400_000))) for i in range(500)]
    assert run(spark, rows) == brute(rows)


def test_ties_repeats_nulls_and_times_before_1970(spark):
    old = datetime(1969, 12, 31, 23, 50)
    rows = [(5, "a", START), (4, "a", START), (4, "a", START), (6, "", START), (7, None, START), (8, "a", None), (None, "a", START), (1, "b", old), (2, "b", old + timedelta(minutes=20))]
    got = run(spark, rows)
    assert got == brute(rows)
    assert ("a", START, START, 2, 4, 5) in got


def test_empty_table(spark):
    assert run(spark, []) == []
