"""Answers about whole traces and about change over time.

Questions about a trace's fate are asked as one grouping per trace over the
decoded records, instead of joining the records of one stage to the next. The
group keeps only flags and counts, which combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.functions.windows import event_ms, floor_ms, tumble, window_bounds
from hoptrail.operators.percentiles import DIMS, exact_percentiles, latency_percentiles
from hoptrail.operators.reports import per_trace, second_window
from hoptrail.operators.stuck import silent_spells, stuck_traces

HOUR = 3_600_000


def _produced_on(topic: str) -> Column:
    return F.col("consumer_service").isNull() & F.col("this_topic").eqNullSafe(topic)


def _consumed_by(service: str) -> Column:
    return F.col("consumer_service").eqNullSafe(service)


def trace_pipeline(produce: DataFrame) -> DataFrame:
    """The pipeline each trace belongs to, and whether its records agree."""
    name = F.coalesce("pipeline", F.lit(""))
    return produce.groupBy("trace_id").agg(
        F.max("pipeline").alias("pipeline"), (F.min(name) == F.max(name)).alias("consistent")
    )


def relay_survival(signal_rows: DataFrame, services: Sequence[str] = wire.CHAIN[1:3]) -> DataFrame:
    """Per relaying service: traces it consumed, and how many of those it sent on."""
    steps = signal_rows.select(
        "trace_id",
        F.coalesce("consumer_service", "this_service").alias("service"),
        F.col("consumer_service").isNotNull().alias("consumed"),
    ).where(F.col("service").isin(*services))
    traces = steps.groupBy("service", "trace_id").agg(
        F.bool_or("consumed").alias("consumed"), F.bool_or(~F.col("consumed")).alias("sent")
    )
    return traces.groupBy("service").agg(
        F.count_if("consumed").alias("consumed_traces"),
        F.count_if(F.col("consumed") & F.col("sent")).alias("sent_on"),
    )


def service_graph(consume: DataFrame) -> DataFrame:
    """Service-to-service edges per minute. A marker names both ends of its
    edge, so the graph needs no join of produce edges to consume edges."""
    traces, key = per_trace(consume, ["pipeline", "producer_service", "consumed_topic", "consumer_service"])
    dims = ["pipeline", "producer_service", "topic", "consumer_service"]
    counted = traces.withColumnRenamed("consumed_topic", "topic").groupBy(second_window(key), *dims).agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("distinct_traces")
    )
    return counted.select(window_bounds(counted)[0], *dims, "records", "distinct_traces")


def traces_per_pipeline(produce: DataFrame) -> DataFrame:
    """Distinct traces and records per pipeline and minute."""
    traces, key = per_trace(produce, ["pipeline"])
    counted = traces.groupBy(second_window(key), "pipeline").agg(
        F.count(F.lit(1)).alias("distinct_traces"), F.sum("n").alias("records")
    )
    return counted.select(window_bounds(counted)[0], "pipeline", "distinct_traces", "records")


def latency_around(produce: DataFrame, moment_ms: int, span_ms: int = 2 * HOUR) -> DataFrame:
    """Average latency in equal spans before and after a moment, per topic."""
    at = event_ms()
    before = at < moment_ms
    near = produce.where((at >= moment_ms - span_ms) & (at < moment_ms + span_ms))
    latency = F.col("latency_ms").cast("double")
    return (
        near.groupBy("pipeline", "this_topic")
        .agg(
            F.avg(F.when(before, latency)).alias("before_ms"),
            F.avg(F.when(~before, latency)).alias("after_ms"),
        )
        .withColumn("change_ms", F.col("after_ms") - F.col("before_ms"))
    )


def completion(signal_rows: DataFrame, first: str = wire.PLACED, terminal: str = wire.SHIPPING) -> DataFrame:
    """Share of the traces placed at the first topic that the terminal consumer got."""
    placed, done = _produced_on(first), _consumed_by(terminal)
    traces = signal_rows.where(placed | done).groupBy("trace_id").agg(
        F.max("pipeline").alias("pipeline"), F.bool_or(placed).alias("placed"), F.bool_or(done).alias("done")
    )
    completed = F.count_if("done")
    return (
        traces.where("placed")
        .groupBy("pipeline")
        .agg(
            F.count(F.lit(1)).alias("placed"),
            completed.alias("completed"),
            (completed / F.count(F.lit(1))).alias("completion_share"),
        )
    )


def lost_between(produce: DataFrame, topics: Sequence[str] = wire.STAGE_TOPICS) -> DataFrame:
    """Per pair of adjacent topics: traces seen on the first and missing on the second."""
    traces = produce.groupBy("trace_id").agg(
        *[F.bool_or(F.col("this_topic").eqNullSafe(t)).alias(f"on_{i}") for i, t in enumerate(topics)]
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(topics[i]).alias("from_topic"),
                F.lit(topics[i + 1]).alias("to_topic"),
                F.col(f"on_{i}").alias("seen"),
                (F.col(f"on_{i}") & ~F.col(f"on_{i + 1}")).alias("lost"),
            )
            for i in range(len(topics) - 1)
        ]
    )
    return traces.select(F.inline(pairs)).groupBy("from_topic", "to_topic").agg(
        F.count_if("seen").alias("traces"), F.count_if("lost").alias("lost")
    )


def duplicates(consume: DataFrame, terminal: str = wire.SHIPPING) -> DataFrame:
    """Traces the terminal consumer took more than once."""
    return (
        consume.where(F.col("consumer_service") == terminal)
        .groupBy("trace_id", "consumer_service")
        .agg(F.count(F.lit(1)).alias("times"))
        .where(F.col("times") > 1)
    )


def unfinished(produce: DataFrame, last: Sequence[str] = (wire.FULFILLED,)) -> DataFrame:
    """Traces that fell silent before the last topics, and where they were last seen."""
    return stuck_traces(produce, terminal_topics=last)


def first_appearance(produce: DataFrame) -> DataFrame:
    """The first minute each service shows up in."""
    return produce.groupBy("this_service").agg(floor_ms(F.min(event_ms())).alias("first_window_start"))


def pipeline_percentiles(produce: DataFrame) -> DataFrame:
    """Latency percentiles over a pipeline's whole history."""
    return exact_percentiles(produce, ["pipeline"], "latency_ms")


def worst_minute(produce: DataFrame) -> DataFrame:
    """The minute with the highest 99th percentile, and the records that made it."""
    worst = (
        latency_percentiles(produce)
        .orderBy(F.desc("p99_ms"), "window_start", *DIMS)
        .limit(1)
        .select("window_start", *DIMS, "p99_ms")
    )
    minutes = tumble(produce)[0]
    same = F.col("p.window_start") == F.col("w.window_start")
    for dim in DIMS:
        same = same & F.col(f"p.{dim}").eqNullSafe(F.col(f"w.{dim}"))
    return (
        minutes.alias("p")
        # A single row, by the limit above.
        .join(F.broadcast(worst.alias("w")), same & (F.col("latency_ms") >= F.col("p99_ms")))
        .select("w.*", "trace_id", "latency_ms")
    )


def observed_edges(signal_rows: DataFrame) -> DataFrame:
    """The distinct edges of the service-topic graph, over all time."""
    is_produce = F.col("consumer_service").isNull()
    return signal_rows.select(
        F.when(is_produce, "produce").otherwise("consume").alias("edge_type"),
        F.coalesce("consumer_service", "this_service").alias("service"),
        F.col("this_topic").alias("topic"),
    ).distinct()


def topology_drift(signal_rows: DataFrame, documented: DataFrame) -> DataFrame:
    """Edges seen but not documented, and edges documented but never seen."""
    keys = ["edge_type", "service", "topic"]
    both = (
        observed_edges(signal_rows)
        .withColumn("seen", F.lit(True))
        .unionByName(documented.select(*keys, F.lit(False).alias("seen")))
        .groupBy(*keys)
        .agg(F.bool_or("seen").alias("seen"), F.bool_or(~F.col("seen")).alias("documented"))
    )
    return both.where(F.col("seen") != F.col("documented")).select(
        *keys, F.when(F.col("seen"), "undocumented").otherwise("missing").alias("drift")
    )


def stuck_rate_around(produce: DataFrame, moment_ms: int) -> DataFrame:
    """Alerts per trace started, before and after a moment."""

    def period(ms: Column) -> Column:
        return F.when(ms < moment_ms, "before").otherwise("after").alias("period")

    alerts = unfinished(produce).select(period(F.col("last_seen_ts_ms")), F.lit(1).alias("alert"))
    started = (
        produce.groupBy("trace_id")
        .agg(F.min(event_ms()).alias("first_ms"))
        .select(period(F.col("first_ms")), F.lit(0).alias("alert"))
    )
    return (
        alerts.unionByName(started)
        .groupBy("period")
        .agg(F.sum("alert").alias("alerts"), F.count_if(F.col("alert") == 0).alias("traces"))
        .withColumn("stuck_rate", F.try_divide("alerts", "traces"))
    )


def stuck_breakdown(produce: DataFrame) -> DataFrame:
    """Alerts by the service, partition and hour of the day they were last seen at.

    ``produce`` must carry ``kafka_partition``; the alert keeps the value of the
    record it is about, so it need not be looked up again.
    """
    alerts = stuck_traces(produce, keep=["kafka_partition"])
    hour = F.hour(F.timestamp_millis("last_seen_ts_ms"))
    return alerts.groupBy("last_service", "kafka_partition", hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("alerts")
    )


def missed_services(produce: DataFrame, expected: Sequence[str] = wire.CHAIN[:3]) -> DataFrame:
    """Traces that did not pass all the services they should have."""
    traces = produce.groupBy("trace_id").agg(
        *[F.bool_or(F.col("this_service").eqNullSafe(s)).alias(f"by_{i}") for i, s in enumerate(expected)]
    )
    missing = [F.when(~F.col(f"by_{i}"), F.lit(s)) for i, s in enumerate(expected)]
    return traces.select("trace_id", F.concat_ws(",", *missing).alias("missing")).where(
        F.col("missing") != ""
    )


def audit(
    signal_rows: DataFrame, first: str = wire.PLACED, last: str = wire.FULFILLED, terminal: str = wire.SHIPPING
) -> DataFrame:
    """Placed traces by outcome: completed, stuck, or neither, which is a violation.

    A trace counts as stuck if it fell silent before the last topic.
    """
    placed, done = _produced_on(first), _consumed_by(terminal)
    spells = silent_spells(signal_rows, F.bool_or(placed).alias("placed"), F.bool_or(done).alias("done"))
    silent = F.col("silent") & ~F.col("last.topic").eqNullSafe(last)
    traces = spells.groupBy("trace_id").agg(
        F.bool_or("placed").alias("placed"), F.bool_or("done").alias("done"), F.bool_or(silent).alias("stuck")
    )
    outcome = (
        F.when(F.col("done") & F.col("stuck"), "completed after alert")
        .when(F.col("done"), "completed")
        .when(F.col("stuck"), "stuck")
        .otherwise("violation")
    )
    return traces.where("placed").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("traces"))


def correlate(produce: DataFrame, business: DataFrame, trace_key: Column, business_key: str) -> DataFrame:
    """Traces beside the rows of another system that share a business key.

    Each trace is reduced to one row before the join, so a trace with very many
    records does not bring them all to one task.
    """
    traces = produce.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("records"), F.max(event_ms()).alias("last_ms")
    )
    return traces.withColumn(business_key, trace_key).join(business, business_key)
