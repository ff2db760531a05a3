"""Other tables seen as messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.functions.temporal import moment
from murmurate.schema import as_timestamps, col


def messages_from_events(df: DataFrame) -> DataFrame:
    """Events of a user's day as a conversation; the event type as channel, its properties as text."""
    df = as_timestamps(df)
    return df.select(
        F.concat_ws("::", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("conversation_id"),
        F.col("event_id").cast("string").alias("message_id"), F.col("user_id").cast("string").alias("from"), F.lit(None).cast("string").alias("to"),
        F.col("ts").alias("date"), F.col("event_type").alias("channel"), F.col("props").alias("text"), F.col("value").alias("value"),
    )


def messages_from_documents(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("source").alias("conversation_id"), F.col("doc_id").cast("string").alias("message_id"), F.col("lang").alias("from"),
        F.lit(None).cast("string").alias("to"), F.col("created_at").cast("timestamp").alias("date"), "channel", "text",
    )


def once_per_message(df: DataFrame, delivery: tuple[str, ...] = ("load_batch", "ingested_at"), key: str = "message_id") -> DataFrame:
    """Deliveries of the same message as one row; its date as timestamp, NULL if unreadable.

    Copies are equal but for the delivery; should they differ, each column
    takes its smallest value. Every column is an aggregate of its own, so that
    those a query does not use are neither read nor shuffled, which DISTINCT
    over whole rows would not allow.
    """
    kept = [c for c in df.columns if c not in delivery]
    once = df.groupBy(col(key)).agg(*[F.min(col(c)).alias(c) for c in kept if c != key]).select(*[col(c) for c in kept])
    return once.withColumn("date", moment(col("date").cast("string")))
