import pytest
from pyspark.sql import functions as F

from murmurate.operators import modeling
from murmurate.plans import queries


def test_every_frequent_level_is_kept(spark):
    df = spark.range(24_000).select((F.col("id") % 1200).alias("c"))
    assert len(modeling.frequent_levels(df, "c")) == 1200
    with pytest.raises(ValueError, match="more than 1199"):
        modeling.frequent_levels(df, "c", most=1199)


def test_every_topic_has_a_priority(spark, monkeypatch):
    summary = spark.range(27_500).select((F.col("id") % 1100).cast("string").alias("most_common_topic"), F.lit(True).alias("conversation_was_answered"))
    monkeypatch.setattr(queries, "summary", lambda *_: summary)
    assert queries.topic_priorities(spark, "").count() == 1100
