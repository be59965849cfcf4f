"""What became of each trace, on a stream.

A placed record waits for its completion, and then for its alerts, in an outer join of
two streams with a bound on the time between them. Once the watermark has passed the
bound a trace's fate is final: it leaves the state, with nulls for what never came, and
goes to a table. The questions are then groupings over finished fates, whose counts can
be added up over days without another look at the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail import wire

HORIZON = "1 hour"


def _placed(signal_rows: DataFrame, first: str) -> DataFrame:
    return signal_rows.where(F.col("consumer_service").isNull() & (F.col("this_topic") == first)).select(
        "trace_id", "pipeline", F.col("event_time").alias("placed_time")
    )


def _within(after: str, of: str, horizon: str):
    return F.expr(f"{after} >= {of} - interval {horizon} and {after} <= {of} + interval {horizon}")


def completions(
    signal_rows: DataFrame,
    first: str = wire.PLACED,
    terminal: str = wire.SHIPPING,
    horizon: str = HORIZON,
) -> DataFrame:
    """Placed records of a watermarked stream, each with when the terminal consumer
    took its trace, or null if it did not within ``horizon``. A trace that was placed
    or taken more than once has several rows."""
    done = signal_rows.where(F.col("consumer_service") == terminal).select(
        F.col("trace_id").alias("done_trace"), F.col("event_time").alias("done_time")
    )
    placed = _placed(signal_rows, first)
    near = (F.col("trace_id") == F.col("done_trace")) & _within("done_time", "placed_time", horizon)
    return placed.join(done, near, "left_outer").select(
        "trace_id", "pipeline", "placed_time", "done_time"
    )


def fates(
    completed: DataFrame, alerts: DataFrame, last: str = wire.FULFILLED, horizon: str = HORIZON
) -> DataFrame:
    """Completions joined with the alerts of their traces, both watermarked streams of
    finished rows (``placed_time``, and ``alert_time`` as in :func:`timed_alerts`)."""
    early = alerts.where(~F.col("last_topic").eqNullSafe(last)).select(
        F.col("trace_id").alias("stuck_trace"), "alert_time"
    )
    near = (F.col("trace_id") == F.col("stuck_trace")) & _within("alert_time", "placed_time", horizon)
    return completed.join(early, near, "left_outer").select(
        "trace_id", "pipeline", "placed_time", "done_time", "alert_time"
    )


def timed_alerts(alerts: DataFrame, delay: str) -> DataFrame:
    """Alerts read back from their table, with the event time they can be joined by."""
    return alerts.withColumn("alert_time", F.timestamp_millis("last_seen_ts_ms")).withWatermark("alert_time", delay)


def completion_share(completed: DataFrame) -> DataFrame:
    """Share of the placed traces that the terminal consumer got, per pipeline."""
    traces = completed.groupBy("trace_id").agg(
        F.max("pipeline").alias("pipeline"), F.bool_or(F.col("done_time").isNotNull()).alias("done")
    )
    done = F.count_if("done")
    return traces.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("placed"),
        done.alias("completed"),
        (done / F.count(F.lit(1))).alias("completion_share"),
    )


def audit(finished: DataFrame) -> DataFrame:
    """Placed traces by outcome: completed, stuck, or neither, which is a violation."""
    traces = finished.groupBy("trace_id").agg(
        F.bool_or(F.col("done_time").isNotNull()).alias("done"),
        F.bool_or(F.col("alert_time").isNotNull()).alias("stuck"),
    )
    outcome = (
        F.when(F.col("done") & F.col("stuck"), "completed after alert")
        .when(F.col("done"), "completed")
        .when(F.col("stuck"), "stuck")
        .otherwise("violation")
    )
    return traces.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("traces"))


def drop_off(
    signal_rows: DataFrame, upstream: str = wire.ENRICHED, downstream: str = wire.FULFILLED, horizon: str = "5 minutes"
) -> DataFrame:
    """Records on a topic, as produced and as consumed, each with when its trace came
    to the next topic in the same way, or null if it did not within ``horizon``."""
    kind = F.col("consumer_service").isNotNull()
    sent = signal_rows.where(F.col("this_topic") == upstream).select(
        "trace_id", kind.alias("consumed"), F.col("event_time").alias("sent_time")
    )
    came = signal_rows.where(F.col("this_topic") == downstream).select(
        F.col("trace_id").alias("came_trace"), kind.alias("came_consumed"), F.col("event_time").alias("came_time")
    )
    near = (
        (F.col("trace_id") == F.col("came_trace"))
        & (F.col("consumed") == F.col("came_consumed"))
        & _within("came_time", "sent_time", horizon)
    )
    return sent.join(came, near, "left_outer").select("trace_id", "consumed", "sent_time", "came_time")


def drop_off_per_minute(matched: DataFrame) -> DataFrame:
    """Per minute of sending: traces on the topic and those that never came to the next."""
    minute = F.unix_millis("sent_time") - F.pmod(F.unix_millis("sent_time"), F.lit(wire.WINDOW_MS))
    traces = matched.groupBy(minute.alias("window_start"), "consumed", "trace_id").agg(
        F.bool_or(F.col("came_time").isNotNull()).alias("came")
    )
    return traces.groupBy("window_start", "consumed").agg(
        F.count(F.lit(1)).alias("traces"), F.count_if(~F.col("came")).alias("dropped")
    )
