import pytest

from murmurate.llm import sampling as s

DDL = "message_id long, channel string, load_batch int, key_hash string"


def draw(spark, rows, thresholds=None, default=0.3, **kw):
    df = spark.createDataFrame(rows, DDL)
    out = s.stable_sample(df.repartition(kw.pop("n", 3)), key="message_id", stratum="channel", thresholds=thresholds or {}, default=s.threshold_of(default), version=("load_batch",))
    return {r.message_id: r.stratum for r in out.collect()}


def rows(n, batch=1):
    return [(i, ["#a", "#b", None][i % 3], batch, "clash") for i in range(n)]


def test_same_in_any_layout_and_kept_as_data_grows(spark):
    a = draw(spark, rows(2000))
    assert a == draw(spark, rows(2000)[::-1], n=7)
    assert 0.25 < len(a) / 2000 < 0.35
    more = draw(spark, rows(2000) + [(i, "#b", 2, "x") for i in range(1500, 4000)])
    assert all(more.get(k) == v for k, v in a.items())


def test_strata_and_raised_thresholds(spark):
    low = s.raise_thresholds({}, {"#a": 0.5, "#b": 0.0})
    a = draw(spark, rows(3000), low, 0.1)
    per = {k: sum(v == k for v in a.values()) for k in ("#a", "#b", "")}
    assert 430 < per["#a"] < 570 and per["#b"] == 0 and 60 < per[""] < 140
    raised = s.raise_thresholds(low, {"#a": 0.2, "#b": 0.1})
    assert raised["#a"] == low["#a"] and raised["#b"] > 0
    assert set(a) <= set(draw(spark, rows(3000), raised, 0.1))


def test_null_keys_copies_and_empty(spark):
    got = draw(spark, [(None, "#a", 1, "")] + [(1, "#b", 2, ""), (1, "#a", 1, ""), (1, "#a", 1, "")], default=1.0)
    assert got == {1: "#a"} and draw(spark, []) == {}
    with pytest.raises(ValueError):
        s.threshold_of(1.5)
