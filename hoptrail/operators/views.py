"""The decoded views: one pass over raw records gives typed signal columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.functions.headers import header_struct_sql, header_text, reversed_keys_sql

_LATENCY = "try_subtract(unix_millis(event_time), origin_ts_ms)"


_FIELDS = {
    "trace_id": wire.TRACE_ID,
    "origin_ts": wire.ORIGIN_TS,
    "origin_service": wire.ORIGIN_SERVICE,
    "pipeline": wire.PIPELINE,
    "this_service": wire.THIS_SERVICE,
    "this_topic": wire.THIS_TOPIC,
    "hop_count": wire.HOP_COUNT,
    "consumer_service": wire.CONSUMER_SERVICE,
}


def header_texts(raw: DataFrame, keep: Sequence[str] = (), fields: Sequence[str] | None = None) -> DataFrame:
    """Look up the scalar headers of each record once, as a struct ``tag``: all of
    them or those of ``fields``, the others being null.

    Filters on a decoded column would be pushed below a plain projection and
    look its header up again for every condition. They stay above a generator,
    so the lookups happen in one place and the rest works on plain columns.
    """
    wanted = {field: _FIELDS[field] for field in (_FIELDS if fields is None else fields)}
    lookups = header_struct_sql(wanted, keys="header_keys")
    found = raw.selectExpr("*", f"{reversed_keys_sql()} as header_keys").selectExpr(
        *keep, f"explode(array({lookups})) as tag"
    )
    return found if fields is None else _filled(found, wanted, keep)


def _filled(found: DataFrame, wanted: Iterable[str], keep: Sequence[str]) -> DataFrame:
    """The same struct ``tag`` with nulls for the headers that nobody looked up."""
    texts = [f"'{f}', " + (f"tag.{f}" if f in wanted else "cast(null as string)") for f in _FIELDS]
    return found.selectExpr(*keep, f"named_struct({', '.join(texts)}) as tag")


# What tells a produced record from a marker, and both from untagged records.
_ALWAYS = ("trace_id", "consumer_service")


def signals(raw: DataFrame, keep: Sequence[str] = (), fields: Sequence[str] | None = None) -> DataFrame:
    """All tagged records, produced ones and consume markers together.

    ``consumer_service`` is null on produced records. Reports over both kinds
    read this frame once instead of reading the raw records twice. ``keep``
    names further raw columns to carry along. A number that cannot be read is
    null rather than the end of the job. A report that names its ``fields`` has only
    those looked up.
    """
    wanted = None if fields is None else (*_ALWAYS, *fields)
    return _typed(header_texts(raw, ["event_time", *keep], wanted), keep)


def _typed(texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return texts.where("tag.trace_id is not null").selectExpr(
        "tag.trace_id",
        "try_cast(tag.origin_ts as bigint) as origin_ts_ms",
        "tag.origin_service",
        "tag.pipeline",
        "tag.this_service",
        "tag.this_topic",
        "try_cast(tag.hop_count as int) as hop_count",
        "tag.consumer_service",
        "event_time",
        *keep,
    )


def text_columns(raw: DataFrame, fields: Sequence[str], by_trace: bool = True) -> DataFrame:
    """Event time and the looked-up headers of all records, untagged ones too, as plain
    columns to be stored for :func:`text_signals`. Ids are most of such a table; without
    ``by_trace`` an empty one stands for each, which still tells tagged records."""
    trace = "tag.trace_id" if by_trace else "if(tag.trace_id is null, null, '')"
    return header_texts(raw, ["event_time"], (*_ALWAYS, *fields)).selectExpr(
        "event_time", f"{trace} as trace_id", "tag.consumer_service", *[f"tag.{f}" for f in fields]
    )


def text_signals(texts: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The signals of stored text columns. A generator again keeps the filters where they
    are: pushed below a watermark, they would hide from it the time of untagged records."""
    wanted = (*_ALWAYS, *fields)
    pairs = ", ".join(f"'{f}', {f}" for f in wanted)
    tags = texts.selectExpr("event_time", f"explode(array(named_struct({pairs}))) as tag")
    return _typed(_filled(tags, wanted, ["event_time"]))


def with_latency(df: DataFrame) -> DataFrame:
    """Milliseconds from the trace's origin to this record; null when unknown."""
    return df.withColumn("latency_ms", F.expr(_LATENCY))


def produced(signal_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Produce view of decoded signals: genuine produced records with latency."""
    return with_latency(signal_rows.where(F.col("consumer_service").isNull())).select(
        "trace_id",
        "origin_ts_ms",
        "origin_service",
        "pipeline",
        "this_service",
        "this_topic",
        "hop_count",
        "event_time",
        "latency_ms",
        *keep,
    )


def consumed(signal_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Consume view of decoded signals: one row per consume marker."""
    return signal_rows.where(F.col("consumer_service").isNotNull()).select(
        "trace_id",
        "origin_ts_ms",
        "origin_service",
        "pipeline",
        F.col("this_service").alias("producer_service"),
        F.col("this_topic").alias("consumed_topic"),
        "consumer_service",
        F.col("hop_count").alias("hop_count_at_consume"),
        "event_time",
        *keep,
    )


def produce_view(raw: DataFrame, keep: Sequence[str] = (), fields: Sequence[str] | None = None) -> DataFrame:
    return produced(signals(raw, keep, fields), keep)


def consume_view(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return consumed(signals(raw, keep), keep)


def fan_in(*sources: DataFrame) -> DataFrame:
    """Union of raw streams of several topics."""
    first, *rest = sources
    for other in rest:
        first = first.unionByName(other)
    return first


def untagged_rate(raw: DataFrame) -> DataFrame:
    """Per topic: records, records without a trace, and their share."""
    untagged = F.count_if(header_text(wire.TRACE_ID).isNull())
    return raw.groupBy("kafka_topic").agg(
        F.count(F.lit(1)).alias("records"),
        untagged.alias("untagged"),
        (untagged / F.count(F.lit(1))).alias("untagged_rate"),
    )


def rejected_headers(raw: DataFrame) -> DataFrame:
    """Per topic: tagged records whose numeric headers are present but unreadable."""
    tagged = header_texts(raw, ["kafka_topic"]).where("tag.trace_id is not null")
    return tagged.groupBy("kafka_topic").agg(
        F.count(F.lit(1)).alias("tagged"),
        F.expr("count_if(tag.origin_ts is not null and try_cast(tag.origin_ts as bigint) is null)").alias(
            "bad_origin_ts"
        ),
        F.expr("count_if(tag.hop_count is not null and try_cast(tag.hop_count as int) is null)").alias(
            "bad_hop_count"
        ),
    )


def trace_age(produce: DataFrame, as_of_ms: int) -> DataFrame:
    """Age of each record's trace at a stated moment."""
    return produce.select(
        "trace_id",
        "this_topic",
        "event_time",
        F.try_subtract(F.lit(as_of_ms), "origin_ts_ms").alias("age_ms"),
    )
