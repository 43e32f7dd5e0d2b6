"""Event-time windows over an event stream: an extension of this engine's own, not part of its batch surface."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str, late: str, keys: list[str], time: str = "ts", value: str = "value") -> DataFrame:
    """Counts and sums by window and keys; rows later than ``late`` are dropped when streaming."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    out = rows.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, gap: str, late: str, keys: list[str], time: str = "ts") -> DataFrame:
    """Sessions that a pause of ``gap`` ends."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    out = rows.groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")
