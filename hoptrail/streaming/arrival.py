"""Stuck traces in arrival order.

The session windows of :mod:`hoptrail.operators.stuck` give the same alerts
whatever the order and batching of records. This variant instead keeps the
record that arrived last, even if it is an older one, and fires a timer a
minute of event time after it. Timers fire between micro-batches, so it suits a
live stream and not a replay.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hoptrail import schemas, wire
from hoptrail.functions.windows import event_ms

_STATE = (
    "origin_service string, pipeline string, service string, topic string, hop_count int, seen_ms bigint"
)


class LastArrival(StatefulProcessor):
    """Remembers a trace's last arrival; alerts when its timer runs out."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            last = row
        self.last.update(
            (
                last["origin_service"],
                last["pipeline"],
                last["this_service"],
                last["this_topic"],
                last["hop_count"],
                last["seen_ms"],
            )
        )
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last["seen_ms"] + self.gap_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        origin_service, pipeline, service, topic, hop_count, seen_ms = self.last.get()
        # A later hop starts over, so nothing needs to be kept after the alert.
        self.last.clear()
        yield Row(
            trace_id=key[0],
            origin_service=origin_service,
            pipeline=pipeline,
            last_service=service,
            last_topic=topic,
            last_hop_count=hop_count,
            last_seen_ts_ms=seen_ms,
            stuck_for_ms=self.gap_ms,
        )

    def close(self) -> None:
        pass


def stuck_by_arrival(produce: DataFrame, gap_ms: int = wire.STUCK_AFTER_MS) -> DataFrame:
    """Alerts of a watermarked produce stream, in arrival order."""
    return (
        produce.select(
            "trace_id",
            "origin_service",
            "pipeline",
            "this_service",
            "this_topic",
            "hop_count",
            event_ms().alias("seen_ms"),
            F.col("event_time"),
        )
        .groupBy("trace_id")
        .transformWithState(
            statefulProcessor=LastArrival(gap_ms),
            outputStructType=schemas.REPORTS["stuck_trace_alerts_1m"],
            outputMode="append",
            timeMode="eventTime",
        )
    )
