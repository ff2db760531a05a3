"""Streaming twins of date aggregation and sessions over timestamped messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurate.schema import col


def windowed_counts(stream: DataFrame, *, time: str = "date", window: str = "1 day", delay: str = "1 hour", keys: tuple[str, ...] = ()) -> DataFrame:
    """Messages and senders per tumbling window; a window is final once the watermark has passed it.

    Distinct senders are estimated, as exact distinct counts need unbounded state.
    """
    late = stream.withWatermark(time, delay)
    out = late.groupBy(F.window(col(time), window), *[col(k) for k in keys]).agg(
        F.count("*").alias("message_count"), F.approx_count_distinct(col("from")).alias("approx_senders")
    )
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[col(k) for k in keys], "message_count", "approx_senders")


def streamed_sessions(stream: DataFrame, *, user: str = "from", time: str = "date", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions of users as they close; a message exactly one gap later begins a new one here."""
    late = stream.withWatermark(time, delay).where(col(user).isNotNull())
    out = late.groupBy(F.session_window(col(time), gap), col(user)).agg(F.count("*").alias("event_count"), F.min(col(time)).alias("session_start"), F.max(col(time)).alias("session_end"))
    return out.select(col(user).alias("user_name"), "session_start", "session_end", "event_count")


def run_available(result: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there, exactly once, and stops."""
    q = result.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
