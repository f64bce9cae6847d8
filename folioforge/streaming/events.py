"""Event windows and sessions; one builder serves tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark; tables as they are. Times without a zone are UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def by_window(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events and their values by time window and kind; on a stream, events later than `late`
    behind the latest are dropped and a window is final once the watermark has passed it."""
    got = _timed(events, late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return got.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Runs of events of one user without a pause of `gap`."""
    got = _timed(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return got.select("user_id", F.col("w.start").alias("session_start"), "n")


def first_seen(events: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    """Each key once; on a stream, repeats are recognised within the watermark."""
    return _timed(events, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])
