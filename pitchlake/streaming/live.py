"""Live variants over streams of detections or events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """df whose time is a timestamp, as watermarks need it (files may hold it without a zone)."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def counts_by_window(events: DataFrame, late: str = "10 minutes", length: str = "1 hour", step: str | None = None) -> DataFrame:
    """Events and their mean value by type in tumbling windows, or sliding ones with a step;
    what comes later than `late` behind the newest is left out."""
    at = F.window("ts", length, step) if step else F.window("ts", length)
    kept = with_event_time(events).withWatermark("ts", late)
    found = kept.groupBy(at.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("mean_value"))
    return found.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n_events", "mean_value")


def sightings(events: DataFrame, gap: str = "1 hour", late: str = "10 minutes", key: str = "user_id") -> DataFrame:
    """Spells of a key's events with no pause longer than gap: the live counterpart of the
    ball gate's islands, where a long pause begins anew."""
    kept = with_event_time(events).withWatermark("ts", late)
    found = kept.groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n_events"))
    return found.select(key, F.col("w.start").alias("spell_start"), F.col("w.end").alias("spell_end"), "n_events")
