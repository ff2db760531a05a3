from datetime import datetime

import pytest
from pyspark.sql import functions as F

from murmurate.operators import gold, reports, validate
from murmurate.plans.pipeline import silver_to_gold
from murmurate.sources.readers import collection, read_silver

DDL = (
    "message_id long, conversation_id long, date timestamp, `from` string, `to` string, channel string, text_cleaned string, word_count long, text_length long, vader_compound double, vader_label string, "
    "transformer_expected_sentiment double, transformer_score double, transformer_label string, transformer_negative double, transformer_neutral double, transformer_positive double, days_since_release_bucket string, "
    "days_until_release_bucket string, topic_id int, topic_label string, tech_lexicon_matches array<struct<term:string,category:string>>, tech_lexicon_match_count long, residual_words array<string>, named_entities string"
)
ROWS = [
    (10, 1, datetime(2020, 1, 1, 0, 2), "alice", "bob", "support", "great fix", 2, 9, 0.8, "POSITIVE", 0.9, 0.99, "POSITIVE", 0.0, 0.1, 0.9, "0-30", "31-90", 0, "packages", [("apt", "package_management")], 1, ["mystery"], '[{"text":"Lantern","label":"PRODUCT"}]'),
    (11, 1, datetime(2020, 1, 1, 0, 0), "bob", "alice", "support", "bad failure SPANISH", 3, 19, -0.6, "NEGATIVE", -0.9, 0.99, "NEGATIVE", 0.9, 0.1, 0.0, "0-30", "31-90", 1, "kernel", [("kernel", "operating_system")], 1, ["failure"], "[]"),
    (12, 2, datetime(2020, 1, 2), "alice", "carol", "install", "neutral question", 2, 16, 0.0, "NEUTRAL", 0.0, 0.7, "NEUTRAL", 0.1, 0.7, 0.2, "31-90", "0-30", None, None, [], 0, [], "[]"),
]


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(ROWS, DDL)


def keyed(df, key):
    return {r[key]: r for r in df.collect()}


def test_conversations(silver):
    g = keyed(gold.gold_conversation(silver), "conversation_id")
    assert g[1].conversation_was_answered and not g[2].conversation_was_answered
    assert (g[1].avg_transformer_expected_sentiment, g[1].avg_transformer_confidence) == (0.0, 0.99)
    assert (g[1].participant_count, g[1].conversation_duration_mins, g[2].participant_count) == (2, 2.0, 2)


def test_users(silver):
    g = keyed(gold.gold_user(silver), "user")
    a = g["alice"]
    assert (a.sent_avg_transformer_expected_sentiment, a.received_avg_transformer_expected_sentiment) == (0.45, -0.9)
    assert (a.sent_message_count, a.received_message_count, a.total_interactions, a.unique_contacts) == (2, 1, 3, 2)
    assert g["carol"].sent_message_count == 0 and g["carol"].sent_avg_word_count is None


def test_terms_entities_languages(silver):
    assert set(keyed(gold.gold_technical(silver), "technical_term")) == {"apt", "kernel"}
    assert {r.entity_source for r in gold.gold_entity(silver).collect()} == {"technical_lexicon", "spacy_ner"}
    g = keyed(gold.gold_language(silver), "language_label")
    assert set(g) == {"SPANISH", "UNLABELED"} and sum(r.message_count for r in g.values()) == 3
    assert set(keyed(gold.gold_residual(silver), "residual_word")) == {"mystery", "failure"}


def test_modes_and_shares_leave_null_out(spark):
    df = spark.createDataFrame([(1, "POSITIVE"), (1, "NEGATIVE"), (1, None)], "k int, vader_label string")
    r = gold.aggregate(df, ["k"]).first()
    assert r.most_common_vader_label == "NEGATIVE" and r.vader_positive_share == 0.5


def test_week_begins_on_monday_and_null_dates_go(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 23),), (datetime(2024, 1, 8),), (None,)], "date timestamp")
    assert sorted(r.date_period for r in gold.gold_date(df, "week").collect()) == [datetime(2024, 1, 1), datetime(2024, 1, 8)]
    with pytest.raises(ValueError):
        gold.gold_date(df, "year")


@pytest.mark.parametrize("level", [x for x in gold.LEVELS])
def test_all_levels_validate(silver, level):
    out, report = silver_to_gold(silver, level)
    assert out.count() > 0 and report["gold_level"] == level
    with pytest.raises(ValueError):
        gold.gold(silver, "nonsense")


def test_empty_silver(spark, silver):
    for level in gold.LEVELS:
        assert gold.gold(silver.limit(0), level).count() == 0


def test_array_shapes(spark):
    df = spark.createDataFrame([([["apt", "pm"]], ["x"], 5)], "tech_lexicon_matches array<array<string>>, residual_words array<string>, n int")
    assert [(r.technical_term, r.technical_category) for r in gold.gold_technical(df).collect()] == [("apt", "pm")]
    with pytest.raises(TypeError):
        gold.terms_of(df, "n", ["a"])


def test_malformed_entities_fail(spark):
    df = spark.createDataFrame([("not valid [",)], "named_entities string")
    with pytest.raises(Exception, match="malformed"):
        gold.gold_entity(df).collect()


def test_collections_from_text(spark):
    rows = [("['a', \"b's\"]",), ('["x"]',), ("",), (None,), ("nan",)]
    df = spark.createDataFrame(rows, "c string")
    assert [r[0] for r in df.select(collection(F.col("c"), "array<string>", "c")).collect()] == [["a", "b's"], ["x"], [], [], []]
    with pytest.raises(Exception, match="malformed"):
        spark.createDataFrame([("not valid [",)], "residual_words string").transform(read_silver).collect()
    loose = spark.createDataFrame([("not valid [",)], "residual_words string").transform(lambda d: read_silver(d, strict=False))
    assert loose.first().residual_words == []


def test_conservation_is_checked(silver):
    g = gold.gold_conversation(silver)
    with pytest.raises(validate.ValidationError, match="messages"):
        validate.validate_gold(g.where("conversation_id = 1"), ["conversation_id"], silver=silver)
    with pytest.raises(validate.ValidationError, match="repeated"):
        validate.validate_gold(g.union(g), ["conversation_id"])


def test_priorities_and_filters(spark):
    t = spark.createDataFrame([("low", 100, 0.2), ("high", 100, 0.8), ("tiny", 2, 0.0)], "topic string, conversations long, answer_rate double")
    assert [r.topic for r in reports.topic_priorities(t).collect()] == ["low", "high"]
    assert reports.topic_priorities(t.select("topic")).count() == 0
    s = spark.createDataFrame([(1, datetime(2020, 1, 31, 23), True, "packages"), (2, datetime(2020, 2, 1), True, "packages")], "conversation_id int, conversation_start timestamp, conversation_was_answered boolean, most_common_topic string")
    assert [r.conversation_id for r in reports.filter_summary(s, start="2020-01-01", end="2020-01-31", answered=True, topic="packages").collect()] == [1]
    assert reports.filter_summary(s, topic="All").count() == 2


def test_reports(silver):
    assert {r.conversation_id: r.ended_by_op for r in reports.ended_by_opener(silver).collect()} == {1: False, 2: True}
    p = keyed(reports.user_profile(silver), "user")
    assert (p["alice"].sent, p["alice"].received, p["alice"].op_rate) == (2, 1, 0.5)
    assert p["bob"].messages_per_active_day is None
    assert reports.multiparty(silver).first().multiparty == 0
    assert reports.weekday_by_hour(silver).where("hour = 0").first().Wednesday == 2
