"""Coverage and session counts over streams, an extension: the batch operators' aggregations with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, key: str, ts: str, width: str, late: str = "1 hour") -> DataFrame:
    """key, start, n per tumbling window; rows later than the watermark are dropped (streams only)."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(key, F.window(ts, width)).agg(F.count("*").alias("n")).select(key, F.col("window.start").alias("start"), "n")


def session_counts(events: DataFrame, key: str, ts: str, gap: str, late: str = "1 hour") -> DataFrame:
    """key, start, end, n per session of rows at most gap apart."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(key, F.session_window(ts, gap)).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
