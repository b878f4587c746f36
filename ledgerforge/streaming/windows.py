"""Windows over events, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """start, event_type, n, total; on a stream rows later than `late` behind the newest are dropped."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """user_id, start, n: runs of a user's events without so long a pause."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")
