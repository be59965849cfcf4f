"""A service of the chain as a streaming job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from hoptrail import wire
from hoptrail.operators.relay import stage_output
from hoptrail.sources import kafka
from hoptrail.streaming import sinks


def run_stage(
    raw: DataFrame,
    service: str,
    out_topic: str | None,
    folder: str,
    checkpoint: str,
    sent_ms: Column | None = None,
    marker_topic: str = wire.MARKER_TOPIC,
    every: str | None = wire.CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Consume a topic, leave a marker per traced record and, unless the service
    is terminal, send each record on, to one table partitioned by topic.

    The table's log makes a repeated batch count once, and a new checkpoint on a
    table that has one is refused."""
    sent = stage_output(raw, service, out_topic, marker_topic, sent_ms)
    return sinks.start_append(sent, f"stage-{service}", folder, checkpoint, every, ("kafka_topic",))


def run_stage_to_kafka(
    raw: DataFrame,
    service: str,
    out_topic: str | None,
    servers: str,
    checkpoint: str,
    marker_topic: str = wire.MARKER_TOPIC,
    every: str | None = wire.CHECKPOINT_EVERY,
) -> StreamingQuery:
    """The same to Kafka topics, keys and headers included, at least once; a stage that
    reads them can drop the repeats with :mod:`hoptrail.streaming.once`."""
    sent = kafka.stage_records(stage_output(raw, service, out_topic, marker_topic))
    return sinks.start_records(sent, f"stage_{service}".replace("-", "_"), servers, checkpoint, every)
