"""Records once, behind a log or a sink that may repeat them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.operators.trails import RECORD

_MARKS = ("_mark_one", "_mark_two")


def by_coordinates(raw: DataFrame, delay: str = wire.WATERMARK_DELAY) -> DataFrame:
    """A log read more than once: the same topic, partition and offset come through
    once, as long as the repeats come within ``delay`` of event time."""
    return raw.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(RECORD))


def by_content(
    raw: DataFrame, delay: str = wire.WATERMARK_DELAY, of: Sequence[str] = ("kafka_topic", "key", "value", "headers")
) -> DataFrame:
    """Records that a stage wrote again after a failure, with new offsets: a relayed
    record names its trace, its hops and their times in its headers, a started trace
    takes its id from what it was started for, so a repeat is the same in all of it.
    Two 64-bit hashes stand for the content. Untagged records come through as they are."""
    tagged = F.exists("headers", lambda h: h["key"] == wire.TRACE_ID)
    marks = [F.xxhash64(F.lit(i), *of) for i in range(len(_MARKS))]
    own = F.xxhash64(F.lit("untagged"), *RECORD)
    marked = raw.withWatermark("event_time", delay).withColumns(
        {name: F.when(tagged, mark).otherwise(own) for name, mark in zip(_MARKS, marks)}
    )
    return marked.dropDuplicatesWithinWatermark(list(_MARKS)).drop(*_MARKS)
