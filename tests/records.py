"""Hand-made raw records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from hoptrail import schemas, wire

START = 1704067200000
TRACE = "018cc251f4007000000000000000002a"


def when(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms // 1000, dt.timezone.utc).replace(
        microsecond=ms % 1000 * 1000
    )


def headers(**values) -> list[tuple[str, bytes]]:
    """Headers by the names of the constants in ``wire``, in lower case."""
    return [
        (getattr(wire, name.upper()), None if value is None else str(value).encode())
        for name, value in values.items()
    ]


def record(ms: int, *, topic=wire.PLACED, trace=TRACE, origin=START, service=wire.INTAKE, hop=1,
           pipeline="orders", consumer=None, extra=()):
    fields = dict(trace_id=trace, origin_ts=origin, origin_service=wire.INTAKE, pipeline=pipeline,
                  this_service=service, this_topic=topic, hop_count=hop)
    fields = {name: value for name, value in fields.items() if value is not None}
    if consumer:
        fields["consumer_service"] = consumer
    sits_on = wire.MARKER_TOPIC if consumer else topic
    return (b"payload", headers(**fields) + list(extra), when(ms), sits_on, 0, ms, b"key")


def frame(spark: SparkSession, records) -> DataFrame:
    """Raw records; those given without a key have none."""
    return spark.createDataFrame([r if len(r) == len(schemas.RAW) else (*r, None) for r in records], schemas.RAW)


def golden_chain():
    """One trace through the whole chain: three produced records, three markers."""
    steps = [
        (wire.PLACED, wire.INTAKE, 1, 0, wire.ENRICHMENT),
        (wire.ENRICHED, wire.ENRICHMENT, 2, 500, wire.FULFILLMENT),
        (wire.FULFILLED, wire.FULFILLMENT, 3, 1500, wire.SHIPPING),
    ]
    rows = []
    for topic, service, hop, offset, consumer in steps:
        common = dict(topic=topic, service=service, hop=hop)
        rows.append(record(START + offset, **common))
        rows.append(record(START + offset + 100, consumer=consumer, **common))
    return rows
