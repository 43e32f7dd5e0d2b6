"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: ANSI stays on, times are UTC, a repeated map key keeps its last value, skewed joins are split at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; ``more`` overrides (dots written as double underscores)."""
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    for k, v in SETTINGS.items() | {k.replace("__", "."): v for k, v in more.items()}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
