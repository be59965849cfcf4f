"""Stuck traces: an alert when a trace stays silent for a minute of event time.

Every silence counts, also the one after the last hop; pass
``terminal_topics`` to leave out traces whose last record reached one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.windows import event_ms, floor_ms
from hoptrail.wire import STUCK_AFTER_MS


def _seen(keep: Sequence[str]) -> Column:
    """A record as it is remembered. The largest one is the latest; ties go to
    the higher hop, then by name."""
    return F.struct(
        event_ms().alias("seen_ms"),
        "hop_count",
        F.col("this_topic").alias("topic"),
        F.col("this_service").alias("service"),
        "origin_service",
        "pipeline",
        *keep,
    )


def _alerts(df: DataFrame, gap_ms: int, terminal_topics: Sequence[str], keep: Sequence[str]) -> DataFrame:
    if terminal_topics:
        unfinished = ~F.col("last.topic").isin(*terminal_topics)
        df = df.where(F.col("last.topic").isNull() | unfinished)
    return df.select(
        "trace_id",
        "last.origin_service",
        "last.pipeline",
        F.col("last.service").alias("last_service"),
        F.col("last.topic").alias("last_topic"),
        F.col("last.hop_count").alias("last_hop_count"),
        F.col("last.seen_ms").alias("last_seen_ts_ms"),
        F.lit(gap_ms).cast("bigint").alias("stuck_for_ms"),
        *[F.col(f"last.{name}") for name in keep],
    )


def silent_spells(
    rows: DataFrame, *measures: Column, gap_ms: int = STUCK_AFTER_MS, keep: Sequence[str] = ()
) -> DataFrame:
    """Each trace of a static frame as one row per gap-sized slot, with its last
    produced record there and whether a silence of at least the gap follows.

    Slots lose nothing: two records in one slot are closer than the gap. Only
    these rows are put in order, so a trace that owns a large share of all
    records still makes a short list. Rows with a ``consumer_service`` do not
    break a silence, and a slot with only such rows is never silent; they are
    there for further ``measures``.
    """
    produced = F.col("consumer_service").isNull() if "consumer_service" in rows.columns else F.lit(True)
    slots = (
        rows.where(F.col("event_time").isNotNull())
        .groupBy("trace_id", floor_ms(event_ms(), gap_ms).alias("slot"))
        .agg(
            F.min(F.when(produced, event_ms())).alias("first_ms"),
            F.max(F.when(produced, _seen(keep))).alias("last"),
            *measures,
        )
    )
    # Backwards in time, so that the frame grows by a row at each step.
    later = Window.partitionBy("trace_id").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    next_ms = F.last("first_ms", ignorenulls=True).over(later)
    ends = next_ms.isNull() | (next_ms - F.col("last.seen_ms") >= gap_ms)
    return slots.withColumn("silent", F.col("last").isNotNull() & ends)


def stuck_traces(
    produce: DataFrame,
    gap_ms: int = STUCK_AFTER_MS,
    terminal_topics: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One alert per silent spell of a trace: session windows on a stream, slots
    on a static frame."""
    if produce.isStreaming:
        # Session windows also join records that are exactly their gap apart.
        spells = produce.groupBy(
            F.session_window("event_time", f"{gap_ms * 1000 - 1} microseconds"), "trace_id"
        ).agg(F.max(_seen(keep)).alias("last"))
    else:
        spells = silent_spells(produce, gap_ms=gap_ms, keep=keep).where("silent")
    return _alerts(spells, gap_ms, terminal_topics, keep)
