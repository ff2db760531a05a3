from datetime import datetime

import pytest
from pyspark.sql import functions as F

from murmurate.operators import prepare
from murmurate.operators.joins import asof_join
from murmurate.operators.skew import salted_join
from murmurate.operators.sorted_runs import scan_runs
from murmurate.plans.pipeline import bronze_to_silver
from murmurate.schema import TO_ALL, TO_UNANSWERED, normalized_names
from murmurate.session import Scratch

D = "conversation_id long, message_id long, `from` string, date timestamp"


def at(minute, day=1, month=1):
    return datetime(2020, month, day, 0, minute)


def test_names_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` DialogueID ` int, `My Col` int")
    assert normalized_names(df).columns == ["dialogue_id", "my_col"]
    with pytest.raises(ValueError):
        normalized_names(spark.createDataFrame([(1, 2)], "a int, `A ` int"))
    with pytest.raises(KeyError):
        prepare.clean_bronze(spark.createDataFrame([("x",)], "text string"))


def test_turns_do_not_depend_on_input_order(spark):
    rows = [(1, 3, "alice", at(2)), (1, 1, "bob", at(0)), (1, 2, "alice", at(1))]
    for order in (rows, rows[::-1]):
        out = prepare.turn_features(spark.createDataFrame(order, D), ("message_id",))
        got = {r.message_id: (r.turn_count, r.is_op, r.response_gap_mins, r.response_gap_mins_between_speakers) for r in out.collect()}
        assert got == {1: (0, True, None, None), 2: (1, False, 1.0, 1.0), 3: (2, False, 1.0, None)}


def test_turns_go_on_across_months(spark):
    rows = [(1, i, "a" if i % 2 else "b", datetime(2020, 1 + i // 3, 28, 23, i)) for i in range(12)]
    got = sorted((r.message_id, r.turn_count, r.response_gap_mins) for r in prepare.turn_features(spark.createDataFrame(rows, D), ("message_id",)).collect())
    assert [t for _, t, _ in got] == list(range(12))
    assert [g for _, _, g in got][1:] == [(rows[i][3] - rows[i - 1][3]).total_seconds() / 60 for i in range(1, 12)]


def test_user_activity(spark):
    rows = [(1, i, "u", datetime(2020, 1 if i < 11 else 2, 1, 0, i)) for i in range(15)] + [(2, 99, None, at(0))]
    got = {r.message_id: r for r in prepare.user_features(spark.createDataFrame(rows, D), ("message_id",)).collect()}
    assert [got[i].user_message_count for i in range(15)] == list(range(1, 16))
    assert got[0].user_messages_this_month == 11 and got[0].user_tier == "regular" and got[14].user_tier == "occasional"
    assert got[99].user_message_count == 1


def test_inference_of_senders_and_recipients(spark):
    rows = [(1, 1, "a", None, at(0)), (1, 2, "b", None, at(1)), (1, 3, None, "a", at(2)), (2, 4, "a", None, at(0)), (3, 5, None, None, at(0)), (4, 6, "a", None, at(0)), (4, 7, "b", None, at(1)), (4, 8, "c", None, at(2))]
    df = spark.createDataFrame(rows, "conversation_id long, message_id long, `from` string, `to` string, date timestamp")
    got = {r.message_id: (r["from"], r["to"]) for r in prepare.infer_participants(df, ("message_id",)).collect()}
    assert got == {1: ("a", TO_ALL), 2: ("b", "a"), 3: ("b", "a"), 4: ("a", TO_UNANSWERED), 6: ("a", TO_ALL), 7: ("b", TO_ALL), 8: ("c", TO_ALL)}


def test_deduplication_is_deterministic(spark):
    df = spark.createDataFrame([(3, "x", "k"), (1, "x", "k"), (2, "y", "k")], "id int, a string, b string")
    got = prepare.deduplicate(df.repartition(3), ("a", "b"), ("id",)).collect()
    assert sorted((r.id, r.a) for r in got) == [(1, "x"), (2, "y")]


def test_conversation_features_leave_sentinels_out(spark):
    df = spark.createDataFrame([(1, "a", "__ALL__", at(0)), (1, "b", "a", at(5)), (None, "c", None, at(1))], "conversation_id long, `from` string, `to` string, date timestamp")
    got = {r.conversation_id: r for r in prepare.conversation_features(df).collect()}
    assert (got[1].conversation_participant_count, got[1].conversation_duration_mins, got[1].conversation_was_answered) == (2, 5.0, True)
    assert got[None].conversation_message_count == 1 and not got[None].conversation_was_answered


def test_release_distance(spark):
    df = spark.createDataFrame([(datetime(2005, 4, 8, 5),), (datetime(2005, 4, 20),), (datetime(2000, 1, 1),)], "date timestamp")
    c = prepare.release_distance(F.col("date"), ["2005-10-12", "2004-10-26", "2005-04-08"])
    got = [tuple(r) for r in df.select(*c.values()).collect()]
    assert got == [(0, 0, "0-1wk", "0-1wk"), (12, 175, "1-2wk", "8wk+"), (None, 1760, None, "8wk+")]


def test_sizes_and_samples(spark):
    c = prepare.text_sizes(F.col("t"))
    got = [tuple(r) for r in spark.createDataFrame([("a  b\nc ",), ("   ",), ("",)], "t string").select(*c.values()).collect()]
    assert got == [(7, 3), (3, 0), (0, 0)]
    df = spark.range(50).withColumnRenamed("id", "message_id")
    a = {r[0] for r in prepare.seeded_sample(df, 10).collect()}
    assert a == {r[0] for r in prepare.seeded_sample(df.repartition(7), 10).collect()} and len(a) == 10
    assert prepare.seeded_sample(df, 500).count() == 50
    with pytest.raises(ValueError):
        prepare.seeded_sample(df, 0)


def test_stable_ids(spark):
    df = spark.createDataFrame([(1, 2), (None, 2)], "folder long, dialogue_id long")
    got = [r.conversation_id for r in prepare.with_conversation_id(df).collect()]
    import hashlib

    assert got == [hashlib.sha256(x.encode()).hexdigest() for x in ("1::2", "<NULL>::2")]


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_join_matches_brute_force(spark, direction):
    left = [(i, None if i == 7 else datetime(2020, 1 + i % 12, 1 + i % 27)) for i in range(60)]
    right = [(f"r{i}", datetime(2020, 1 + 3 * i, 5)) for i in range(4)]
    got = asof_join(spark.createDataFrame(left, "i int, t timestamp"), spark.createDataFrame(right, "name string, t2 timestamp"), left_on="t", right_on="t2", values=["name"], direction=direction)
    back = direction == "backward"

    def near(t):
        c = [(x, n) for n, x in right if t is not None and (x <= t if back else x >= t)]
        return (max(c) if back else min(c))[1] if c else None

    assert {r.i: r.name for r in got.collect()} == {i: near(t) for i, t in left}


def test_salted_join_equals_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)] + [(999, None)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = salted_join(left, right, ["k"], spread=["i"], how=how), left.join(right, ["k"], how)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], spread=["i"], how="full")


def test_runs_cross_partitions(spark):
    rows = [("hot", i, 1) for i in range(400)] + [(f"g{i % 5}", 1000 + i, i) for i in range(50)] + [(None, 5000, 7), ("", 5001, 8)]
    df = spark.createDataFrame(rows, "g string, i long, v long")
    got = scan_runs(df.repartition(5), ["g"], ["i"], scratch=Scratch(spark, "t"), value=F.col("v"), head="i", partitions=16).collect()
    expected, state = {}, {}
    for g, i, v in sorted(rows, key=lambda r: (str(type(r[0])), r[0] or "", r[1])):
        total, rank, head = state.get((g,), (0, 0, i))
        state[(g,)] = (total + v, rank + 1, head)
        expected[i] = state[(g,)]
    assert {r.i: (r.running_total, r.run_rank, r.run_head) for r in got} == expected
    assert scan_runs(df.limit(0), ["g"], ["i"], scratch=Scratch(spark, "t"), head="i").count() == 0
    with pytest.raises(ValueError):
        scan_runs(df.withColumn("run_rank", F.lit(1)), ["g"], ["i"], scratch=Scratch(spark, "t"))


def test_a_hot_group_is_spread_over_tasks(spark):
    """A third of all rows are one sender's, of one conversation, in one minute; no task gets much more than its share."""
    rows = [(1 if i % 3 == 0 else 100 + i, i, "hot" if i % 3 == 0 else f"u{i}", at(0)) for i in range(6000)]
    df = spark.createDataFrame(rows, D).repartition(6)
    kept = {}

    class Kept(Scratch):
        def write(self, df, name):
            kept[name] = out = super().write(df, name)
            return out

    out = scan_runs(df, ["from"], ["date", "message_id"], scratch=Kept(spark, "hot"), partitions=12, lag=["message_id"])
    per_task = [r["count"] for r in kept["runs"].where("__run_single IS NULL").groupBy("__run_pid").count().collect()]
    assert len(per_task) >= 10 and max(per_task) < 3 * 6000 / 12
    hot = sorted((r.run_rank, r.message_id, r.prev_message_id) for r in out.where("`from` = 'hot'").collect())
    assert hot == [(i + 1, 3 * i, 3 * (i - 1) if i else None) for i in range(2000)]
    turned = {r.message_id: r.turn_count for r in prepare.turn_features(df, ("message_id",)).where("conversation_id = 1").collect()}
    assert turned == {3 * i: i for i in range(2000)}


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_scan_equals_the_constant_array(spark, direction):
    left = spark.createDataFrame([(i, i % 3, None if i == 7 else datetime(2020, 1 + i % 12, 1 + i % 27)) for i in range(90)], "i int, k int, t timestamp")
    right = spark.createDataFrame([(f"r{i}", i % 3 if i else None, datetime(2020, 1 + i % 12, 5)) for i in range(14)], "name string, k int, t2 timestamp")
    both = [{r.i: r.name for r in asof_join(left, right.drop("k"), left_on="t", right_on="t2", values=["name"], direction=direction, constant_rows=n).collect()} for n in (0, 200)]
    assert both[0] == both[1] and both[0][7] is None
    keyed = {r.i: r.name for r in asof_join(left.repartition(5), right, left_on="t", right_on="t2", values=["name"], by=["k"], direction=direction).collect()}
    pairs = [(x.t2, x.name, x.k) for x in right.collect()]
    for r in left.collect():
        c = [(x, n) for x, n, k in pairs if r.t is not None and k == r.k and (x <= r.t if direction == "backward" else x >= r.t)]
        best = (max(c)[0] if direction == "backward" else min(c)[0]) if c else None
        assert keyed[r.i] == (max(n for x, n in c if x == best) if c else None)


def test_ids_of_a_message_and_its_copy_without_sender(spark):
    rows = [(1, "a", "b", "hi", at(0)), (2, "b", "a", "same", at(1)), (3, None, "a", "same", at(1)), (4, "a", "b", "bye", at(2))]
    rows = [(1, 7, *r) for r in rows] + [(1, 8, i + 10, *r) for i, *r in rows[:2]]
    schema = "folder long, dialogue_id long, row_id long, `from` string, `to` string, text string, date timestamp"
    rows = [(f, k, i, s, t, x + str(k), d) for f, k, i, s, t, x, d in rows]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema)
        plain = {r.row_id: r for r in prepare.prepare_bronze(df, tie_break=("row_id",)).collect()}
        got = {r.row_id: r for r in prepare.prepare_bronze(df, tie_break=("row_id",), unique_ids=True).collect()}
        assert plain[2].message_id == plain[3].message_id and len({r.message_id for r in got.values()}) == len(got) == 6
        assert {i for i in got if got[i].message_id != plain[i].message_id} == {3}
        assert [{**r.asDict(), "message_id": 0} for _, r in sorted(got.items())] == [{**r.asDict(), "message_id": 0} for _, r in sorted(plain.items())]


def test_given_ids_are_left_as_they_are(spark):
    df = spark.createDataFrame([("x", 1, "a", None, "hi", at(0)), ("x", 1, "a", None, "ho", at(0))], "message_id string, conversation_id long, `from` string, `to` string, text string, date timestamp")
    assert [r.message_id for r in prepare.prepare_bronze(df, unique_ids=True).collect()] == ["x", "x"]


def test_silver_of_a_message_and_its_copy_without_sender(spark):
    rows = [("1", "1.tsv", "2010-01-01T10:00:00Z", "ann", "bob", "hi"), ("1", "1.tsv", "2010-01-01T10:01:00Z", "bob", "ann", "same"), ("1", "1.tsv", "2010-01-01T10:01:00Z", " ", "ann", "same")]
    df = spark.createDataFrame(rows, "folder string, dialogue_id string, date string, `from` string, `to` string, text string")
    got = bronze_to_silver(df, [("apt", "TOOL")], linguistic=False, sentiment_mode=None).collect()
    assert sorted((r["from"], r.text_cleaned) for r in got) == [("ann", "hi"), ("bob", "same"), ("bob", "same")] and len({r.message_id for r in got}) == 3


def test_a_side_is_broadcast_only_if_it_is_small_with_its_salts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left = spark.range(4000).selectExpr("id", "concat('w', id % 2000) AS w")
    right = spark.createDataFrame([(f"w{i}",) for i in range(1000)], "w string")
    try:
        for most, joined in (("100k", "SortMergeJoin"), ("8m", "BroadcastHashJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            for salts in (1, 9, 16):
                out = salted_join(left, right, ["w"], spread=["id"], how="left_semi", salts=salts)
                assert sorted(r.id for r in out.collect()) == [i for i in range(4000) if i % 2000 < 1000]
            assert joined in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_divided_side_is_never_broadcast(spark):
    left, right = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, w string"), spark.createDataFrame([("a", 5), ("c", 6)], "w string, n int")
    out = salted_join(left, right, ["w"], spread=["id"])
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastNestedLoopJoin", "").replace("BroadcastExchange IdentityBroadcastMode", "")
    assert [(r.id, r.n) for r in out.collect()] == [(1, 5)]
