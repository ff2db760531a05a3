"""Analyses over messages and gold tables: profiles, pivots, rankings, key figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import minutes_between, right_closed
from murmurate.operators.prepare import DURATION_BOUNDS, MESSAGE_COUNT_BOUNDS
from murmurate.operators.statistics import quantile, quantiles
from murmurate.schema import col

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def ended_by_opener(df: DataFrame, tie: Sequence[str] = ("message_id",)) -> DataFrame:
    """``conversation_id, ended_by_op``: whether the opener wrote the last message."""
    order = F.struct("date", *[col(t) for t in tie])
    ends = df.where("date IS NOT NULL").groupBy("conversation_id").agg(F.min_by("from", order).alias("a"), F.max_by("from", order).alias("b"))
    return ends.select("conversation_id", (F.col("a") == F.col("b")).alias("ended_by_op"))


def user_profile(df: DataFrame, tie: Sequence[str] = ("message_id",)) -> DataFrame:
    """Sent and received counts, opening rate, usual month and year, activity per conversation and day."""
    df = df.where("date IS NOT NULL")
    order = F.struct("date", *[col(t) for t in tie])
    opener = df.groupBy("conversation_id").agg(F.min_by("from", order).alias("op"))
    own = df.where(col("from").isNotNull()).groupBy(col("from").alias("user"), "conversation_id").agg(F.count("*").alias("n"), F.avg("word_count").alias("w"))
    own = own.join(opener, "conversation_id")
    per = own.groupBy("user").agg(
        F.avg((F.col("op") == F.col("user")).cast("int")).alias("op_rate"), F.count("*").alias("conversations"), F.avg("n").alias("avg_messages_per_conversation"),
        F.avg("w").alias("avg_words_per_conversation"),
    )
    sent = df.where(col("from").isNotNull()).groupBy(col("from").alias("user")).agg(
        F.count("*").alias("sent"), F.mode(F.month("date"), True).alias("usual_month"), F.mode(F.year("date"), True).alias("usual_year"),
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"),
    )
    got = df.where(col("to").isNotNull()).groupBy(col("to").alias("user")).agg(F.count("*").alias("received"))
    days = F.datediff("last_seen", "first_seen")
    return sent.join(got, "user", "left").join(per, "user", "left").withColumns(
        {"received": F.coalesce("received", F.lit(0)), "active_days": days, "messages_per_active_day": F.try_divide("sent", F.nullif(days, F.lit(0)))}
    )


def weighted_monthly_sentiment(summary: DataFrame, value: str = "avg_vader_compound") -> DataFrame:
    """Sentiment by the month a conversation began, weighted by its messages where it has sentiment."""
    month = F.date_trunc("month", "conversation_start")
    scored = F.when(col(value).isNotNull(), col("message_count"))
    return summary.where("conversation_start IS NOT NULL").groupBy(month.alias("month")).agg(
        F.try_divide(F.sum(col(value) * col("message_count")), F.sum(scored)).alias("sentiment"), F.sum("message_count").alias("messages")
    )


def key_figures(summary: DataFrame) -> DataFrame:
    """``conversations, messages, answer_rate, mean_sentiment, median_gap``."""
    aggs = [F.count("*").alias("conversations"), F.coalesce(F.sum("message_count"), F.lit(0)).alias("messages"), F.avg(col("conversation_was_answered").cast("int")).alias("answer_rate")]
    if "avg_vader_compound" in summary.columns:
        aggs.append(F.avg("avg_vader_compound").alias("mean_sentiment"))
    gap = "avg_response_gap_mins_between_speakers"
    if gap in summary.columns:
        aggs.append(F.lit(quantile(summary, gap, 0.5)).cast("double").alias("median_gap"))
    return summary.agg(*aggs)


def topic_answer_rates(summary: DataFrame, topic: str = "most_common_topic", least: int = 25, top: int | None = 15) -> DataFrame:
    """Answer rate of the ``top`` topics with most conversations (None: of all), at least ``least`` each."""
    t = summary.where(col(topic).isNotNull()).groupBy(col(topic).alias("topic")).agg(F.count("*").alias("conversations"), F.avg(col("conversation_was_answered").cast("int")).alias("answer_rate"))
    t = t.where(F.col("conversations") >= least)
    if top is not None:
        t = t.orderBy(F.desc("conversations"), "topic").limit(top)
    return t.orderBy(F.desc("answer_rate"), "topic")


def topic_priorities(topics: DataFrame, least: int = 25, rate: str = "answer_rate", volume: str = "conversations") -> DataFrame:
    """``(1 - rate) * ln(1 + volume)`` per topic with enough volume, largest first; no rows without the columns."""
    if not {rate, volume} <= set(topics.columns):
        return topics.limit(0).withColumn("priority", F.lit(None).cast("double"))
    clipped = F.least(F.greatest(col(rate), F.lit(0.0)), F.lit(1.0))
    scored = topics.where(col(volume) >= least).withColumn("priority", (1 - clipped) * F.log1p(col(volume)))
    return scored.orderBy(F.desc("priority"))


def filter_summary(summary: DataFrame, *, start=None, end=None, answered: bool | None = None, topic: str | None = None) -> DataFrame:
    """Conversations from ``start`` through the day ``end``, by answer and topic; ``All`` is no filter."""
    if start is not None:
        summary = summary.where(col("conversation_start") >= F.lit(start).cast("timestamp"))
    if end is not None:
        summary = summary.where(col("conversation_start") < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    if answered is not None:
        summary = summary.where(col("conversation_was_answered") == answered)
    if topic not in (None, "All"):
        summary = summary.where(col("most_common_topic") == topic)
    return summary


def by_bucket(df: DataFrame, bucket: str, measures: Sequence[str]) -> DataFrame:
    """Mean and exact median of measures per bucket."""
    means = df.groupBy(col(bucket)).agg(F.count("*").alias("messages"), *[F.avg(col(m).cast("double")).alias(f"mean_{m}") for m in measures])
    each = F.array(*[F.struct(F.lit(m).alias("measure"), col(m).cast("double").alias("value")) for m in measures])
    medians = quantiles(df.select(col(bucket).alias("__b"), F.explode(each).alias("x")).select("__b", "x.*"), ["__b", "measure"], "value", [0.5])
    medians = medians.groupBy("__b").agg(*[F.max(F.when(F.col("measure") == m, F.col("q")[0])).alias(f"median_{m}") for m in measures])
    return means.join(medians, col(bucket).eqNullSafe(F.col("__b")), "left").drop("__b")


def pivot_counts(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Counts by ``rows`` and the listed values of ``columns``, 0 where there are none."""
    return df.groupBy(col(rows)).pivot(columns, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def weekday_by_hour(df: DataFrame) -> DataFrame:
    """Messages per UTC hour and weekday, Monday first."""
    when = df.where("date IS NOT NULL").select(F.date_format("date", "EEEE").alias("weekday"), F.hour("date").alias("hour"))
    return pivot_counts(when, "hour", "weekday", WEEKDAYS)


def cross_tab(df: DataFrame, rows: str, flag: str, least: int = 30) -> DataFrame:
    """Counts of a flag by category, categories below ``least`` left out."""
    f = col(flag)
    return df.where(col(rows).isNotNull() & f.isNotNull()).groupBy(col(rows)).agg(F.count_if(~f).alias("no"), F.count_if(f).alias("yes")).where(F.col("no") + F.col("yes") >= least)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts and proportions of values, NULL included."""
    counts = df.groupBy(col(column)).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).first()[0]
    return counts.withColumn("proportion", F.try_divide("count", F.lit(total)))


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with several rows: ``keys, copies``."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_figures(df: DataFrame, keys: Sequence[str], within: str) -> DataFrame:
    """``rows, groups, duplicates`` of equal keys, and how many of the duplicates lie in one ``within``."""
    per = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n"), F.count_distinct(F.coalesce(col(within).cast("string"), F.lit(""))).alias("w"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.col("n") - F.col("w")), F.lit(0)).alias("duplicates_within"),
    )


def multiparty(df: DataFrame) -> DataFrame:
    """``conversations, multiparty, share, rows_affected``: conversations with more than two senders."""
    per = df.groupBy("conversation_id").agg(F.count_distinct("from").alias("s"), F.count("*").alias("n"))
    many = F.col("s") > 2
    out = per.agg(F.count("*").alias("conversations"), F.count_if(many).alias("multiparty"), F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_affected"))
    return out.withColumn("share", F.try_divide("multiparty", "conversations"))


def monthly_volume(df: DataFrame) -> DataFrame:
    return df.where("date IS NOT NULL").groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count("*").alias("messages"))


def conversation_buckets(summary: DataFrame) -> DataFrame:
    """Conversations per size and duration bucket."""
    b = summary.select(
        right_closed(col("message_count"), *MESSAGE_COUNT_BOUNDS).alias("message_count_bucket"), right_closed(col("conversation_duration_mins"), *DURATION_BOUNDS).alias("duration_bucket")
    )
    return b.groupBy("message_count_bucket", "duration_bucket").agg(F.count("*").alias("conversations"))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return df.where(col(column).isNotNull()).groupBy(col(column)).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column).limit(k)


def largest(df: DataFrame, metric: str, k: int, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(metric), *tie).limit(k)


def clipped_at_p99(df: DataFrame, column: str) -> DataFrame:
    """Rows up to the 99th percentile of a column, which is one number."""
    limit = quantile(df, column, 0.99)
    return df.where(col(column) <= F.lit(limit)) if limit is not None else df.limit(0)


def conversation_lengths(df: DataFrame) -> DataFrame:
    """Bounds, messages and minutes of each conversation."""
    g = df.where("date IS NOT NULL").groupBy("conversation_id").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("messages"))
    return g.withColumn("minutes", minutes_between(col("last"), col("first")))
