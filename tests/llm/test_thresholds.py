from murmurate.llm import queries as q
from murmurate.llm import sampling as s


def test_no_rate_and_no_default_falls_below_an_earlier_draw(spark):
    first = s.thresholds_table(spark, *s.grown({"#a": 0.5}, 0.1))
    thresholds, default = s.grown({"#b": 0.02, "#c": 0.3}, 0.05, *s.stored_thresholds(first))
    # #b was drawn at the default of 0.1 before.
    assert thresholds == {"#a": s.threshold_of(0.5), "#b": s.threshold_of(0.1), "#c": s.threshold_of(0.3)} and default == s.threshold_of(0.1)
    assert s.grown({"#b": 0.02}, 0.1) == ({"#b": s.threshold_of(0.02)}, s.threshold_of(0.1))


def test_registered_sample_keeps_an_earlier_one(spark, data):
    earlier = s.thresholds_table(spark, {}, s.threshold_of(0.5))
    def ids(df):
        return {r.message_id for r in df.select("message_id").collect()}

    silver = spark.read.parquet(f"{data}/silver.parquet")
    first = ids(s.stable_sample(silver, key="message_id", stratum="channel", thresholds={}, default=s.threshold_of(0.5), salt=q.SAMPLE_SALT, version=("load_batch", "ingested_at")))
    assert first and first <= ids(q.p4_sample(spark, data, earlier)) and not first <= ids(q.p4_sample(spark, data))
    stored = s.stored_thresholds(q.p4_thresholds(spark, data, earlier))
    assert stored[1] == s.threshold_of(0.5) and min(stored[0].values()) == s.threshold_of(0.5)
