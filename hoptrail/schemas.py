"""Explicit schemas of the raw stream, the two views and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}


def _table(columns: str) -> StructType:
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


HEADERS = ArrayType(
    StructType([StructField("key", StringType()), StructField("value", BinaryType())])
)

RAW = StructType(
    [
        StructField("value", BinaryType()),
        StructField("headers", HEADERS),
        StructField("event_time", TimestampType()),
        StructField("kafka_topic", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("key", BinaryType()),
    ]
)

# The JSON trail: id (base64), origin ms, origin service, pipeline, hops, cut.
TRAIL = StructType(
    [
        StructField("t", StringType()),
        StructField("o", LongType()),
        StructField("s", StringType()),
        StructField("p", StringType()),
        StructField(
            "h",
            ArrayType(
                StructType(
                    [
                        StructField("s", StringType()),
                        StructField("t", StringType()),
                        StructField("m", LongType()),
                    ]
                )
            ),
        ),
        StructField("x", BooleanType()),
    ]
)

PRODUCE = _table(
    "trace_id string, origin_ts_ms bigint, origin_service string, pipeline string,"
    "this_service string, this_topic string, hop_count int, event_time timestamp,"
    "latency_ms bigint"
)

CONSUME = _table(
    "trace_id string, origin_ts_ms bigint, origin_service string, pipeline string,"
    "producer_service string, consumed_topic string, consumer_service string,"
    "hop_count_at_consume int, event_time timestamp"
)

# Headers of a record as they were looked up, before any number is read.
TEXTS = _table(
    "event_time timestamp, trace_id string, origin_ts string, origin_service string,"
    "pipeline string, this_service string, this_topic string, hop_count string,"
    "consumer_service string"
)

REPORTS = {
    "latency_report_1m": _table(
        "window_start bigint, window_end bigint, pipeline string, origin_service string,"
        "this_topic string, sample_count bigint, distinct_traces bigint,"
        "avg_latency_ms double, min_latency_ms bigint, max_latency_ms bigint"
    ),
    "topology_report_1m": _table(
        "window_start bigint, window_end bigint, pipeline string, origin_service string,"
        "producer_service string, topic string, records bigint, distinct_traces bigint"
    ),
    "bipartite_topology_report_1m": _table(
        "window_start bigint, window_end bigint, pipeline string, edge_type string,"
        "producer_service string, topic string, consumer_service string,"
        "origin_service string, records bigint, distinct_traces bigint"
    ),
    "hop_distribution_1m": _table(
        "window_start bigint, window_end bigint, pipeline string, this_topic string,"
        "hop_count int, records bigint, distinct_traces bigint"
    ),
    "coverage_report_1m": _table(
        "window_start bigint, window_end bigint, pipeline string, this_topic string,"
        "origin_service string, distinct_traces bigint, records bigint"
    ),
    "stuck_trace_alerts_1m": _table(
        "trace_id string, origin_service string, pipeline string, last_service string,"
        "last_topic string, last_hop_count int, last_seen_ts_ms bigint, stuck_for_ms bigint"
    ),
    "latency_percentiles_flat_1m": _table(
        "window_start bigint, window_end bigint, pipeline string, origin_service string,"
        "this_topic string, p50_ms double, p95_ms double, p99_ms double, sample_count bigint"
    ),
    "trace_rca_1m": _table(
        "trace_id string, pipeline string, last_service string, last_topic string,"
        "stuck_for_ms bigint, root_cause string"
    ),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Check that ``df`` has exactly the columns and types of ``schema``."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in schema]
    if have != want:
        raise ValueError(f"schema mismatch: have {have}, want {want}")
    return df
