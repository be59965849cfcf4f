"""Stage jobs: what a service does to the headers of the records it handles.

Each operator is a projection of raw records, so it runs on streams and tables
alike and never shuffles. The value, and a ``key`` column if there is one, pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.functions.headers import header_list_sql, header_sql, replaced_headers_sql
from hoptrail.functions.ids import id_for_record, id_from_base64, id_to_base64
from hoptrail.functions.windows import event_ms
from hoptrail.operators.trails import RECORD, parsed_trail

_NO_HOPS = "cast(array() as array<struct<s:string,t:string,m:bigint>>)"


def _sent(df: DataFrame, sent_ms: Column | None) -> DataFrame:
    return df.withColumn("sent_ms", event_ms() if sent_ms is None else sent_ms)


def _stamped(df: DataFrame, service: str, out_topic: str) -> DataFrame:
    """Append a hop to the working columns and write all headers from them."""
    hop = F.struct(F.lit(service).alias("s"), F.lit(out_topic).alias("t"), F.col("sent_ms").alias("m"))
    grown = df.withColumn("all_hops", F.concat("hops", F.array(hop)))
    capped = grown.withColumn(
        "hops",
        F.slice(
            "all_hops", F.greatest(F.lit(1), F.size("all_hops") - wire.MAX_HOPS + 1), F.lit(wire.MAX_HOPS)
        ),
    ).withColumn("cut", F.col("cut") | (F.size("all_hops") > wire.MAX_HOPS))
    trail = capped.withColumn(
        "trail_json",
        F.to_json(
            F.struct(
                id_to_base64(F.col("trace_id")).alias("t"),
                F.col("origin_ms").alias("o"),
                F.col("origin_service").alias("s"),
                F.col("pipeline").alias("p"),
                F.col("hops").alias("h"),
                F.col("cut").alias("x"),
            )
        ),
    )
    entries = {
        wire.TRAIL: "trail_json",
        wire.TRACE_ID: "trace_id",
        wire.ORIGIN_TS: "origin_ms",
        wire.ORIGIN_SERVICE: "origin_service",
        wire.PIPELINE: "pipeline",
        wire.THIS_SERVICE: f"'{service}'",
        wire.THIS_TOPIC: f"'{out_topic}'",
        wire.HOP_COUNT: "size(hops)",
    }
    # A later filter on a header would be pushed below a plain projection and
    # build the headers once more per condition; it stays above a generator.
    built = F.struct(F.expr(replaced_headers_sql(entries)).alias("headers"))
    return (
        trail.withColumn("built", F.explode(F.array(built)))
        .withColumn("headers", F.col("built.headers"))
        .withColumn("event_time", F.timestamp_millis("sent_ms"))
        .withColumn("kafka_topic", F.lit(out_topic))
        .withColumn("kafka_partition", F.lit(None).cast("int"))
        .withColumn("kafka_offset", F.lit(None).cast("bigint"))
        .drop(
            "sent_ms", "trace_id", "origin_ms", "origin_service", "pipeline",
            "hops", "all_hops", "cut", "trail_json", "trail", "built",
        )
    )


def relay(
    raw: DataFrame,
    service: str,
    out_topic: str,
    pipeline: str = "orders",
    sent_ms: Column | None = None,
) -> DataFrame:
    """Consume and produce again: adopt each record's trace and append one hop.

    The id, origin and pipeline stay as they were. A record without a trace
    starts one at this service, with an id derived from its coordinates so that
    a replay gives the same one. Beyond the hop cap the oldest hop is dropped
    and the trail marked. ``sent_ms`` is the time of sending, by default the
    record's own.
    """
    old_id = id_from_base64(F.col("trail.t"))
    adopted = old_id.isNotNull()

    def adopt(old: Column, new: Column) -> Column:
        return F.when(adopted, old).otherwise(new)

    new_id = id_for_record(F.col("sent_ms"), *[F.col(name) for name in RECORD])
    working = _sent(raw.withColumn("trail", parsed_trail()), sent_ms).select(
        "*",
        adopt(old_id, new_id).alias("trace_id"),
        adopt(F.col("trail.o"), F.col("sent_ms")).alias("origin_ms"),
        adopt(F.col("trail.s"), F.lit(service)).alias("origin_service"),
        adopt(F.col("trail.p"), F.lit(pipeline)).alias("pipeline"),
        F.coalesce(F.when(adopted, F.col("trail.h")), F.expr(_NO_HOPS)).alias("hops"),
        F.coalesce(adopted & F.col("trail.x"), F.lit(False)).alias("cut"),
    )
    return _stamped(working, service, out_topic)


def start_traces(
    raw: DataFrame, service: str, topic: str, pipeline: str = "orders", sent_ms: Column | None = None
) -> DataFrame:
    """Send records that have no trace yet: each gets an id and its first hop."""
    untagged = raw.where(F.expr(header_sql(wire.TRAIL)).isNull())
    return relay(untagged, service, topic, pipeline, sent_ms)


def consume_markers(
    raw: DataFrame,
    service: str,
    marker_topic: str = wire.MARKER_TOPIC,
    sent_ms: Column | None = None,
) -> DataFrame:
    """A marker per traced record that ``service`` consumed: the seven scalar
    headers, the consumer's name, no trail, no key and no value."""
    entries = {name: header_sql(name) for name in wire.SCALAR_HEADERS}
    entries[wire.CONSUMER_SERVICE] = f"'{service}'"
    traced = _sent(raw.where(F.expr(header_sql(wire.TRACE_ID)).isNotNull()), sent_ms)
    columns = {
        "value": F.lit(None).cast("binary"),
        "headers": F.expr(header_list_sql(entries)),
        "event_time": F.timestamp_millis("sent_ms"),
        "kafka_topic": F.lit(marker_topic),
        "kafka_partition": F.lit(None).cast("int"),
        "kafka_offset": F.lit(None).cast("bigint"),
        "key": F.lit(None).cast("binary"),
    }
    return traced.select(*[value.alias(name) for name, value in columns.items()])


def stage_output(
    raw: DataFrame,
    service: str,
    out_topic: str | None,
    marker_topic: str = wire.MARKER_TOPIC,
    sent_ms: Column | None = None,
) -> DataFrame:
    """All a service sends for what it consumes: the markers and, unless it is
    terminal, the records themselves with one more hop."""
    markers = consume_markers(raw, service, marker_topic, sent_ms)
    if out_topic is None:
        return markers
    return markers.unionByName(relay(raw, service, out_topic, sent_ms=sent_ms).select(*markers.columns))
