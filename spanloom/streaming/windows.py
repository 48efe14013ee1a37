"""Windows over the stream of events: extensions that the batch operators have counterparts of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, late: str) -> DataFrame:
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return stamped.withWatermark("ts", late) if events.isStreaming else stamped


def window_counts(events: DataFrame, length: str = "6 hours", hop: str | None = None, late: str = "1 hour") -> DataFrame:
    """Count and value of each event type by tumbling or (with hop) sliding window; for batches and streams."""
    by = _timed(events, late).groupBy(F.window("ts", length, hop) if hop else F.window("ts", length), "event_type")
    return by.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """A user's events that follow each other within the gap."""
    by = _timed(events, late).groupBy(F.session_window("ts", gap), "user_id")
    return by.agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("session_start"), F.col("session_window.end").cast("timestamp_ntz").alias("session_end"), "n")
