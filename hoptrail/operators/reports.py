"""The windowed count reports.

All of them count records and distinct traces per minute and some dimensions.
The distinct count is taken in two steps, first per trace and then per
dimension. That is exact, streams in append mode, and spreads a hot service or
topic over all its traces before the rows meet on the report's own key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.windows import tumble, window_bounds


def per_trace(df: DataFrame, dims: Sequence[str], *measures: Column) -> tuple[DataFrame, list[str]]:
    """Level one: a row per window, dimensions and trace, with its record count."""
    windowed, key = tumble(df)
    counted = windowed.groupBy(*key, *dims, "trace_id").agg(
        F.count(F.lit(1)).alias("n"), *measures
    )
    return counted, key


def second_window(key: list[str]) -> Column | str:
    return F.window(F.window_time("window"), "1 minute").alias("window") if key == ["window"] else key[0]


def _counts(df: DataFrame, dims: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    traces, key = per_trace(df, dims)
    counted = traces.groupBy(second_window(key), *dims).agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("distinct_traces")
    )
    return counted, list(window_bounds(counted))


def latency(produce: DataFrame) -> DataFrame:
    """Latency from origin per minute, pipeline, origin and topic."""
    dims = ["pipeline", "origin_service", "this_topic"]
    traces, key = per_trace(
        produce,
        dims,
        F.count("latency_ms").alias("timed"),
        F.sum(F.col("latency_ms").cast("double")).alias("total"),
        F.min("latency_ms").alias("low"),
        F.max("latency_ms").alias("high"),
    )
    counted = traces.groupBy(second_window(key), *dims).agg(
        F.sum("n").alias("sample_count"),
        F.count(F.lit(1)).alias("distinct_traces"),
        F.try_divide(F.sum("total"), F.sum("timed")).alias("avg_latency_ms"),
        F.min("low").alias("min_latency_ms"),
        F.max("high").alias("max_latency_ms"),
    )
    return counted.select(
        *window_bounds(counted),
        *dims,
        "sample_count",
        "distinct_traces",
        "avg_latency_ms",
        "min_latency_ms",
        "max_latency_ms",
    )


def topology(produce: DataFrame) -> DataFrame:
    """Produce edges: which service wrote to which topic, per minute."""
    counted, bounds = _counts(produce, ["pipeline", "origin_service", "this_service", "this_topic"])
    return counted.select(
        *bounds,
        "pipeline",
        "origin_service",
        F.col("this_service").alias("producer_service"),
        F.col("this_topic").alias("topic"),
        "records",
        "distinct_traces",
    )


def bipartite_topology(signal_rows: DataFrame) -> DataFrame:
    """Produce and consume edges of the service-topic graph, per minute.

    Both kinds of edge come from one pass over the decoded records: a marker is
    a consume edge, anything else a produce edge, and the endpoint the edge
    does not have is null.
    """
    is_produce = F.col("consumer_service").isNull()
    edges = signal_rows.select(
        "event_time",
        "trace_id",
        "pipeline",
        "origin_service",
        F.when(is_produce, F.lit("produce")).otherwise(F.lit("consume")).alias("edge_type"),
        F.when(is_produce, F.col("this_service")).alias("producer_service"),
        F.col("this_topic").alias("topic"),
        "consumer_service",
    )
    dims = ["pipeline", "edge_type", "producer_service", "topic", "consumer_service", "origin_service"]
    counted, bounds = _counts(edges, dims)
    return counted.select(*bounds, *dims, "records", "distinct_traces")


def hop_distribution(produce: DataFrame) -> DataFrame:
    """Records by hop count and topic, per minute."""
    dims = ["pipeline", "this_topic", "hop_count"]
    counted, bounds = _counts(produce, dims)
    return counted.select(*bounds, *dims, "records", "distinct_traces")


def coverage(produce: DataFrame) -> DataFrame:
    """Distinct traces seen at each topic, per minute."""
    dims = ["pipeline", "this_topic", "origin_service"]
    counted, bounds = _counts(produce, dims)
    return counted.select(*bounds, *dims, "distinct_traces", "records")


def topology_of_edges(bipartite: DataFrame) -> DataFrame:
    """The topology report out of the finished bipartite one, whose produce edges
    have the same grain."""
    return bipartite.where(F.col("edge_type") == "produce").select(
        "window_start",
        "window_end",
        "pipeline",
        "origin_service",
        "producer_service",
        "topic",
        "records",
        "distinct_traces",
    )


def coverage_of_latency(latency_report: DataFrame) -> DataFrame:
    """The coverage report out of the finished latency one, which has the same
    grain and counts the same things."""
    return latency_report.select(
        "window_start",
        "window_end",
        "pipeline",
        "this_topic",
        "origin_service",
        "distinct_traces",
        F.col("sample_count").alias("records"),
    )
