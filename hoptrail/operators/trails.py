"""Trails and paths: the hops of single traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail import schemas, wire
from hoptrail.functions.headers import header_number, header_text
from hoptrail.functions.ids import id_from_base64, id_origin_ms
from hoptrail.functions.windows import event_ms, floor_ms
from hoptrail.operators.views import header_texts

RECORD = ("kafka_topic", "kafka_partition", "kafka_offset")


def parsed_trail() -> Column:
    """The JSON trail of a raw record; null for an untagged one."""
    return F.from_json(header_text(wire.TRAIL), schemas.TRAIL)


def record_tags(raw: DataFrame) -> DataFrame:
    """Per record: is it tagged, where did its trace start, how many hops so far."""
    return raw.select(
        *RECORD,
        header_text(wire.TRACE_ID).isNotNull().alias("tagged"),
        header_text(wire.ORIGIN_SERVICE).alias("origin_service"),
        header_number(wire.HOP_COUNT, "int").alias("hop_count"),
    )


def _tagged(raw: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Records with a readable trail, parsed once into a column ``trail``; the
    generator keeps later filters from parsing it again."""
    return raw.select(*keep, F.explode(F.array(parsed_trail())).alias("trail")).where(
        F.col("trail.t").isNotNull()
    )


def trails(raw: DataFrame, keep: Sequence[str] = RECORD) -> DataFrame:
    """Decoded trail of every record that carries one."""
    return _tagged(raw, keep).select(
        *keep,
        id_from_base64(F.col("trail.t")).alias("trace_id"),
        F.col("trail.o").alias("origin_ts_ms"),
        F.col("trail.s").alias("origin_service"),
        F.col("trail.p").alias("pipeline"),
        F.col("trail.h").alias("hops"),
        F.coalesce("trail.x", F.lit(False)).alias("truncated"),
    )


def trail_hops(raw: DataFrame) -> DataFrame:
    """One row per hop of every trail, in order from 1. A trail is capped, so
    the list inside a record is always short."""
    return trails(raw).select(
        *RECORD, "trace_id", "truncated", F.posexplode("hops").alias("at", "hop")
    ).select(
        *RECORD,
        "trace_id",
        (F.col("at") + 1).alias("pos"),
        F.col("hop.s").alias("service"),
        F.col("hop.t").alias("topic"),
        F.col("hop.m").alias("ts_ms"),
        "truncated",
    )


def trail_violations(raw: DataFrame) -> DataFrame:
    """Per topic, how many trails disagree with the scalar headers or run
    backwards in time. Every check is local to its record."""
    trail = F.col("trail")
    last = F.element_at("trail.h", -1)
    backwards = F.expr(
        "array_contains(transform(trail.h, (hop, i) -> i > 0 and hop.m < get(trail.h, i - 1).m), true)"
    )

    def differs(name: str, value: Column) -> Column:
        return F.count_if(~F.col(name).eqNullSafe(value))

    checked = (
        _tagged(header_texts(raw, ["kafka_topic", "headers"]), ["kafka_topic", "tag"])
        .withColumn("id", id_from_base64(trail["t"]))
    )
    return checked.groupBy("kafka_topic").agg(
        F.count(F.lit(1)).alias("trails"),
        differs("tag.trace_id", F.col("id")).alias("id_differs"),
        differs("tag.origin_ts", trail["o"].cast("string")).alias("origin_ts_differs"),
        differs("tag.origin_service", trail["s"]).alias("origin_service_differs"),
        differs("tag.pipeline", trail["p"]).alias("pipeline_differs"),
        differs("tag.this_service", last["s"]).alias("service_differs"),
        differs("tag.this_topic", last["t"]).alias("topic_differs"),
        differs("tag.hop_count", F.size(trail["h"]).cast("string")).alias("hop_count_differs"),
        F.count_if(backwards).alias("backwards"),
        F.count_if(~id_origin_ms(F.col("id")).eqNullSafe(trail["o"])).alias("id_time_differs"),
    )


def journey_rows(signal_rows: DataFrame) -> DataFrame:
    """Everything that happened to a trace, produces and consumes alike."""
    is_produce = F.col("consumer_service").isNull()
    return signal_rows.select(
        "trace_id",
        event_ms().alias("event_ms"),
        F.when(is_produce, "produce").otherwise("consume").alias("step"),
        F.coalesce("consumer_service", "this_service").alias("service"),
        F.col("this_topic").alias("topic"),
        "hop_count",
    )


def path_rows(produce: DataFrame) -> DataFrame:
    """The produce hops of a trace only."""
    return produce.select(
        "trace_id",
        event_ms().alias("event_ms"),
        F.col("this_service").alias("service"),
        F.col("this_topic").alias("topic"),
        "hop_count",
    )


def in_order(
    rows: DataFrame, order: Sequence[str], slot_ms: int = wire.WINDOW_MS
) -> DataFrame:
    """Number the rows of each trace from 1 in event-time order.

    ``order`` and the event time must tell apart all rows that differ. Equal rows
    are counted first, and positions come from running sums of counts through two
    levels: minutes of a trace, distinct rows of a minute. However many records a trace
    has, no task sorts more than its minutes, or what differs among the records of one
    (60,000 milliseconds, by what ``order`` tells apart). Rows without an event time
    come last.
    """
    columns = rows.columns
    counted = (
        rows.withColumn("at", F.coalesce("event_ms", F.lit(2**63 - 1)))
        .groupBy(*columns, "at")
        .agg(F.count(F.lit(1)).alias("n"))
        # Never null, and said so: else the join below would filter one of the two
        # frames made from this one, and Spark could not share its shuffle.
        .withColumn("slot", F.coalesce(floor_ms(F.col("at"), slot_ms), F.lit(0)))
    )

    def running(df: DataFrame, within: Sequence[str], by: Sequence[str], name: str) -> DataFrame:
        window = Window.partitionBy(*within).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.sum("n").over(window) - F.col("n"))

    slots = counted.groupBy("trace_id", "slot").agg(F.sum("n").alias("n"))
    slots = running(slots, ["trace_id"], ["slot"], "before_slot").drop("n")
    placed = running(counted, ["trace_id", "slot"], ["at", *order], "before_row").join(slots, ["trace_id", "slot"])
    first = F.col("before_slot") + F.col("before_row") + 1
    return placed.select(*columns, F.explode(F.sequence(first, first + F.col("n") - 1)).alias("pos"))


def trace_path(produce: DataFrame) -> DataFrame:
    """Ordered produce hops of every trace, with the day the trace started."""
    rows = in_order(path_rows(produce), ["hop_count", "topic", "service"])
    return rows.withColumn(
        "origin_day", F.date_format(F.timestamp_millis(id_origin_ms(F.col("trace_id"))), "yyyy-MM-dd")
    )


def trace_journey(signal_rows: DataFrame) -> DataFrame:
    """Ordered produces and consumes of every trace."""
    return in_order(journey_rows(signal_rows), ["hop_count", "step", "topic", "service"])
