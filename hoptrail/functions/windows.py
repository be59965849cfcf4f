"""Event-time windows that work on static and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.wire import WINDOW_MS


def floor_ms(ms: Column, size_ms: int = WINDOW_MS) -> Column:
    """Start of the epoch-aligned window holding ``ms``, also before 1970."""
    return ms - F.pmod(ms, F.lit(size_ms))


def event_ms(column: str = "event_time") -> Column:
    return F.unix_millis(F.col(column))


def tumble(df: DataFrame, size_ms: int = WINDOW_MS) -> tuple[DataFrame, list[str]]:
    """Add the tumbling window of each row; returns the frame and its window key.

    A stream needs Spark's window column, which carries the watermark. A static
    frame gets by with one number, a cheaper grouping key than a pair of
    timestamps.
    """
    if df.isStreaming:
        return df.withColumn("window", F.window("event_time", f"{size_ms} milliseconds")), ["window"]
    dated = df.where(F.col("event_time").isNotNull())
    return dated.withColumn("window_start", floor_ms(event_ms(), size_ms)), ["window_start"]


def window_bounds(df: DataFrame, size_ms: int = WINDOW_MS) -> tuple[Column, Column]:
    """Window bounds in epoch milliseconds for a frame grouped by :func:`tumble`."""
    if "window" in df.columns:
        return (
            F.unix_millis("window.start").alias("window_start"),
            F.unix_millis("window.end").alias("window_end"),
        )
    return F.col("window_start"), (F.col("window_start") + size_ms).alias("window_end")


def slide(df: DataFrame, size_ms: int, step_ms: int = WINDOW_MS) -> DataFrame:
    """Copy each row, already grouped by ``window_start``, into every sliding
    window it belongs to. Meant for the few rows of a minute aggregate."""
    starts = F.sequence(
        F.col("window_start") - (size_ms - step_ms), F.col("window_start"), F.lit(step_ms)
    )
    return df.withColumn("window_start", F.explode(starts))
