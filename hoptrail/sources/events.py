"""Raw records derived from the ``events`` table.

Every event becomes one trace through the three stages of the chain, with the
irregularities the reports must cope with: untagged records, a missing
pipeline, an unreadable origin time or hop count, a pipeline that changes on the
way, traces that stop early, repeated last hops, long silences, a service that is
down for a while, records at the hop ceiling and beyond it, trails that disagree
with their headers, lost markers, and records of the days before and after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hoptrail import wire
from hoptrail.functions.headers import header_list_sql
from hoptrail.wire import CHAIN, MARKER_TOPIC, STAGE_TOPICS

START_MS = 1704067200000  # 2024-01-01T00:00:00Z
TASKS_PER_CORE = 2

_STEP_MS = "(200 + (event_id * 7919) % 4000)"
# Minutes of the day in which the last producing service is down.
_DOWN = "elapsed div 60 >= 11400000 and elapsed div 60 < 12000000 and event_id % 700 <> 11"
_DAYS_OFF = "case event_id % 41 when 0 then 1 when 1 then -1 else 0 end"
_HOPS_SEEN = f"""case when event_id % 10 = 9 then array(1)
     when event_id % 20 = 8 or {_DOWN} then array(1, 2)
     when event_id % 97 = 0 then array(1, 2, 3, 4)
     else array(1, 2, 3) end"""


_PIPELINE = "case when event_id % 200 = 5 then null when event_id % 4 = 0 then 'location' else 'orders' end"


def _texts(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _hops(spark: SparkSession, folder: str) -> DataFrame:
    """One row per hop a trace makes: ``s`` is the stage, ``k`` counts repeats.

    A file is read by as many tasks as it has row groups, often one, and an event becomes
    five records and more. So the events are dealt out before they do."""
    events = (
        read_events(spark, folder)
        .selectExpr(
            "event_id",
            f"unix_millis(cast(ts as timestamp)) - {START_MS} as elapsed",
            "if(event_type = 'error', 'failed', 'success') as status",
        )
        .repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, "event_id")
    )
    return (
        events.selectExpr(
            "event_id",
            "status",
            f"{START_MS} + (elapsed - elapsed % 60) div 60 + 86400000 * {_DAYS_OFF} as origin_ms",
            f"explode({_HOPS_SEEN}) as k",
        )
        .selectExpr("*", "least(k, 3) as s")
        .selectExpr(
            "event_id",
            "status",
            "s",
            "origin_ms",
            f"""origin_ms + (s - 1) * {_STEP_MS} + if(event_id % 25 = 3 and s = 3, 90000, 0)
                + if(k = 4, 1500, 0) as sent_ms""",
            """if(event_id % 50 = 7, null, concat(lpad(lower(hex(origin_ms)), 12, '0'), '7',
                lpad(lower(hex(event_id)), 19, '0'))) as trace_id""",
            "if(event_id % 500 = 13, 'bad', string(origin_ms)) as origin_ts",
            f"'{CHAIN[0]}' as origin_service",
            f"case when event_id % 900 = 17 and s = 2 then 'returns' else {_PIPELINE} end as pipeline",
            f"element_at({_texts(CHAIN[:3])}, s) as this_service",
            f"element_at({_texts(STAGE_TOPICS)}, s) as this_topic",
            """case when event_id % 700 = 11 and s = 2 then 'many' when event_id % 1000 = 1 then '32'
                else string(s) end as hop_count""",
            f"element_at({_texts(CHAIN[1:])}, s) as next_service",
        )
    )


def _broken(remainder: int) -> str:
    """Which last stages carry a trail with one certain thing wrong."""
    return f"s = 3 and event_id % 1300 = {remainder}"


def _trail_sql() -> str:
    """JSON trail of a produced record: all hops up to its own stage. The first record
    of some traces has been through as many hops as a trail keeps."""
    hops = f"""transform(sequence(1, s), k -> named_struct(
             's', if(k = s and {_broken(24)}, 'other-service', element_at({_texts(CHAIN[:3])}, k)),
             't', if(k = s and {_broken(25)}, 'other.topic', element_at({_texts(STAGE_TOPICS)}, k)),
             'm', case when k = s then sent_ms when k = 1 and {_broken(26)} then sent_ms + 1000
                  else origin_ms + (k - 1) * {_STEP_MS} end))"""
    before = f"""transform(sequence(1, {wire.MAX_HOPS - 1}), k -> named_struct(
             's', '{CHAIN[0]}', 't', '{STAGE_TOPICS[0]}', 'm', origin_ms - ({wire.MAX_HOPS} - k)))"""
    return f"""if(trace_id is null, null, to_json(named_struct(
        't', base64(unhex(if({_broken(21)}, overlay(trace_id placing 'f' from 14 for 1), trace_id))),
        'o', origin_ms + if({_broken(22)}, 1, 0),
        's', if({_broken(23)}, 'unknown', origin_service), 'p', {_PIPELINE},
        'h', if(s = 1 and event_id % 1000 = 1, concat({before}, {hops}), {hops}),
        'x', event_id % 1000 = 1)))"""


def raw_records(spark: SparkSession, folder: str, with_trail: bool = False) -> DataFrame:
    """The traces of ``events`` as raw records with encoded headers.

    ``event_id`` and ``status`` stay beside the raw columns; the status of a
    send is known to its sender only and never travels in a header.
    """
    scalars = {
        wire.TRACE_ID: "trace_id",
        wire.ORIGIN_TS: "origin_ts",
        wire.ORIGIN_SERVICE: "origin_service",
        wire.PIPELINE: "pipeline",
        wire.THIS_SERVICE: "this_service",
        wire.THIS_TOPIC: "this_topic",
        wire.HOP_COUNT: "hop_count",
    }
    # A column of its own: a generator would write the JSON out once to see whether it is
    # null and once more for the header.
    trail = {wire.TRAIL: "trail"} if with_trail else {}
    hops = _hops(spark, folder)
    if with_trail:
        hops = hops.selectExpr("*", f"{_trail_sql()} as trail")
    produced = f"""named_struct('value', cast(string(event_id) as binary),
        'key', cast(concat('k', event_id % 100) as binary),
        'headers', {header_list_sql(trail | scalars)},
        'ms', sent_ms, 'kafka_topic', this_topic)"""
    marker = f"""named_struct('value', cast(null as binary),
        'key', cast(null as binary),
        'headers', {header_list_sql(scalars | {wire.CONSUMER_SERVICE: "next_service"})},
        'ms', sent_ms + 50 + event_id % 300, 'kafka_topic', '{MARKER_TOPIC}')"""
    return (
        hops.selectExpr(
            "event_id",
            "status",
            f"explode(array({produced}, if(event_id % 40 = 2, null, {marker}))) as record",
        )
        .where("record is not null")
        .selectExpr(
            "record.value",
            "record.headers",
            "timestamp_millis(record.ms) as event_time",
            "record.kafka_topic",
            "cast(event_id % 6 as int) as kafka_partition",
            "event_id as kafka_offset",
            "record.key",
            "event_id",
            "status",
        )
    )
