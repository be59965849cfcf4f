"""Every query by name, run over the records derived from a table folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.functions.ids import id_origin_ms
from hoptrail.functions.headers import header_text
from hoptrail.functions.windows import event_ms, floor_ms, tumble
from hoptrail.operators import annotate, distincts, meters, percentiles, relay, reports, stuck, trails, views
from hoptrail.plans import questions, replays
from hoptrail.session import scratch_path
from hoptrail.sources import files
from hoptrail.sources.events import raw_records, read_events

Query = Callable[[SparkSession, str], DataFrame]

# The moments asked about: noon, and six hours into the twelve the traces span.
NOON = 1704110400000
DEPLOY = 1704088800000
# First and last day of the paths asked for.
DAYS = ("2024-01-01", "2024-01-01")

# What the documentation of the pipeline claims: it still lists a topic that is
# no longer used and has not heard of the terminal consumer.
DOCUMENTED = [
    ("produce", wire.INTAKE, wire.PLACED),
    ("consume", wire.ENRICHMENT, wire.PLACED),
    ("produce", wire.ENRICHMENT, wire.ENRICHED),
    ("consume", wire.FULFILLMENT, wire.ENRICHED),
    ("produce", wire.FULFILLMENT, wire.FULFILLED),
    ("produce", wire.SHIPPING, "orders.shipped"),
]


def _plain_time(df: DataFrame) -> DataFrame:
    """Event time as epoch milliseconds, which every engine writes alike."""
    return df.withColumn("event_ms", event_ms()).drop("event_time")


def _rounded(df: DataFrame) -> DataFrame:
    """Interpolated values to six places; engines differ in the last bit."""
    names = [c for c in df.columns if c[0] == "p" and c.endswith("_ms")]
    return df.withColumns({c: F.round(c, 6) for c in names})


def _records(spark: SparkSession, folder: str, with_trail: bool = False) -> DataFrame:
    return raw_records(spark, folder, with_trail)


def _raw(query: Callable[[DataFrame], DataFrame], with_trail: bool = False) -> Query:
    return lambda spark, folder: query(_records(spark, folder, with_trail))


def _signals(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _raw(lambda raw: query(views.signals(raw)))


def _produce(
    query: Callable[[DataFrame], DataFrame], *keep: str, fields: Sequence[str] | None = None
) -> Query:
    return _raw(lambda raw: query(views.produce_view(raw, keep, fields)))


def _consume(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _raw(lambda raw: query(views.consume_view(raw)))


def _latency_of_consumes(query: Callable[[DataFrame], DataFrame]) -> Query:
    return _consume(lambda c: query(meters.consume_latency(c)))


def _relay_output(raw: DataFrame) -> DataFrame:
    """What the enrichment service sends for each record placed."""
    placed = raw.where(F.col("kafka_topic") == wire.PLACED)
    sent = relay.relay(placed, wire.ENRICHMENT, wire.ENRICHED, sent_ms=event_ms() + F.lit(250))
    hops = F.expr("concat_ws(',', transform(trail.h, h -> concat_ws('>', h.s, h.t, string(h.m))))")
    decoded = sent.withColumn("trail", trails.parsed_trail()).withColumns(
        {"hops": hops, "truncated": F.col("trail.x")}
    )
    return _plain_time(
        views.signals(decoded, ["event_id", "kafka_topic", "hops", "truncated", "key", "value"])
    ).drop("consumer_service").withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def _started(raw: DataFrame) -> DataFrame:
    """First hops of the placed records that carry no trace yet."""
    placed = raw.where(F.col("kafka_topic") == wire.PLACED)
    sent = relay.start_traces(placed, wire.INTAKE, wire.PLACED)
    return _plain_time(views.produce_view(sent, ["event_id"]))


def _markers(raw: DataFrame) -> DataFrame:
    """The markers the fulfillment service leaves for each record enriched."""
    enriched = raw.where(F.col("kafka_topic") == wire.ENRICHED)
    sent = relay.consume_markers(enriched, wire.FULFILLMENT, sent_ms=event_ms() + F.lit(50))
    return _plain_time(views.consume_view(sent, ["kafka_topic", "key"])).withColumn("key", F.col("key").cast("string"))


def _stand_in():
    """A stand-in for a text model: two sentences from the facts for a first hop,
    one for a second and too much text for a later one.

    The model is defined in here so that it travels to the workers by value and
    they need not have this package installed.
    """

    def open_model():
        def answer(asked):
            facts = [dict(x.split("=", 1) for x in p.split(" ")) for p in asked]
            return [
                f"Nothing consumed {f['last_topic']}."
                + {"1": " Check its consumer.", "2": ""}.get(f["hop_count"], " Wait." + " Check it." * 50)
                for f in facts
            ]

        return answer

    return open_model


def _annotated(produce: DataFrame) -> DataFrame:
    return annotate.root_causes(stuck.stuck_traces(produce), _stand_in())


def _answered(produce: DataFrame) -> DataFrame:
    return annotate.answer_counts(annotate.answers(stuck.stuck_traces(produce), _stand_in()))


def _correlated(spark: SparkSession, folder: str) -> DataFrame:
    event_id = F.conv(F.substring("trace_id", 14, 19), 16, 10).cast("bigint")
    business = read_events(spark, folder).select("event_id", "user_id", "event_type")
    produce = views.produce_view(_records(spark, folder))
    return questions.correlate(produce, business, event_id, "event_id")


def _drift(spark: SparkSession, folder: str) -> DataFrame:
    documented = spark.createDataFrame(DOCUMENTED, "edge_type string, service string, topic string")
    return questions.topology_drift(views.signals(_records(spark, folder)), documented)


def _judged(produce: DataFrame, method: str, error: float) -> DataFrame:
    """Sketched percentiles beside the exact ranks of what they estimate."""
    windowed, key = tumble(produce)
    found = percentiles.latency_percentiles(produce, method)
    return percentiles.within_rank_error(windowed, found, [*key, *percentiles.DIMS], "latency_ms", error)


def _rolled_up(produce: DataFrame) -> DataFrame:
    found = percentiles.merge_sketches(percentiles.latency_sketches(produce), ["pipeline"])
    return percentiles.within_rank_error(produce, found, ["pipeline"], "latency_ms", percentiles.KLL_ERROR)


def _topic_fan_in(raw: DataFrame) -> DataFrame:
    """Records per topic and hour over the union of one frame per topic."""
    topics = [raw.where(F.col("kafka_topic") == topic) for topic in wire.SOURCE_TOPICS]
    hour = floor_ms(event_ms(), 60 * wire.WINDOW_MS)
    return views.fan_in(*topics).groupBy("kafka_topic", hour.alias("hour")).agg(F.count(F.lit(1)).alias("records"))


def _dated_path(spark: SparkSession, folder: str) -> DataFrame:
    """The paths of stated days, read off the landed table of all days."""
    landing = scratch_path(spark, "landed")
    files.land(_records(spark, folder), landing)
    days = files.landed_days(files.read_landed(spark, landing), *DAYS)
    return trails.trace_path(views.produced(days))


def _looked_up(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that happened to the first trace with 32 hops, read off a compacted
    table of all days by its id."""
    landing, compacted = scratch_path(spark, "landed"), scratch_path(spark, "compacted")
    files.land(_records(spark, folder), landing)
    table = files.compact(files.read_landed(spark, landing), compacted, "1970-01-01", "9999-12-31")
    wanted = table.where(F.col("hop_count") == wire.MAX_HOPS).agg(F.min("trace_id")).first()[0]
    return trails.trace_journey(files.trace_records(table, wanted or "0" * 32))


def _distinct_across_days(produce: DataFrame) -> DataFrame:
    """Traces per pipeline over all days, and whether the sketches say the same."""
    sketches = distincts.trace_sketches(produce)
    found = distincts.distinct_traces(sketches, ["pipeline"]).withColumnRenamed("distinct_traces", "estimated")
    exact = produce.groupBy("pipeline", "trace_id").agg(F.lit(1).alias("one")).groupBy("pipeline").agg(
        F.count("one").alias("distinct_traces")
    )
    near = distincts.within_error("estimated", "distinct_traces", "distinct_traces").alias("near")
    same = F.col("e.pipeline").eqNullSafe(F.col("s.pipeline"))
    joined = exact.alias("e").join(found.alias("s"), same)
    return joined.select("e.pipeline", "distinct_traces", near)


def _lost_across_days(produce: DataFrame) -> DataFrame:
    """Traces lost between topics over all days, and whether the sketches say the same."""
    found = distincts.lost_between(distincts.trace_sketches(produce)).withColumnsRenamed(
        {"traces": "estimated", "lost": "estimated_lost"}
    )
    joined = questions.lost_between(produce).join(found, ["from_topic", "to_topic"])
    near = distincts.within_error("estimated", "traces", "traces") & distincts.within_error("estimated_lost", "lost", "traces")
    return joined.select("from_topic", "to_topic", "traces", "lost", near.alias("near"))


HOP_DIMS = ["pipeline", "origin_service", "this_topic"]
EDGE_DIMS = ["pipeline", "origin_service", "this_service", "this_topic"]
CONSUME_DIMS = ["pipeline", "consumer_service", "this_topic"]

QUERIES: dict[str, Query] = {
    # Sources and views.
    "raw_union": _raw(
        lambda raw: raw.select(
            event_ms().alias("event_ms"),
            "kafka_topic",
            "kafka_partition",
            "kafka_offset",
            F.size("headers").alias("header_entries"),
        )
    ),
    "topic_fan_in": _raw(_topic_fan_in),
    "produce_view": _produce(_plain_time),
    "consume_view": _raw(lambda raw: _plain_time(views.consume_view(raw))),
    "untagged_rate": _raw(views.untagged_rate),
    "rejected_headers": _raw(views.rejected_headers),
    "trace_age": _produce(lambda p: _plain_time(views.trace_age(p, NOON))),
    "id_time": _produce(
        lambda p: p.select("trace_id", id_origin_ms(F.col("trace_id")).alias("id_ms")).distinct()
    ),
    # Reports.
    "latency_1m": _produce(reports.latency, fields=["origin_ts", *HOP_DIMS]),
    "topology_1m": _produce(reports.topology, fields=EDGE_DIMS),
    "bipartite_topology_1m": _signals(reports.bipartite_topology),
    "hop_distribution_1m": _produce(reports.hop_distribution, fields=["pipeline", "this_topic", "hop_count"]),
    "coverage_1m": _produce(reports.coverage, fields=HOP_DIMS),
    "latency_percentiles_1m": _produce(lambda p: _rounded(percentiles.latency_percentiles(p))),
    "latency_percentiles_approx": _produce(lambda p: _judged(p, "approx", percentiles.APPROX_ERROR)),
    "latency_percentiles_kll": _produce(lambda p: _judged(p, "kll", percentiles.KLL_ERROR)),
    "latency_sketch_rollup": _produce(_rolled_up),
    "stuck_trace": _produce(stuck.stuck_traces),
    "rca_prompt": _produce(lambda p: annotate.prompts(stuck.stuck_traces(p))),
    "trace_rca": _produce(_annotated),
    "trace_rca_answers": _produce(_answered),
    # Trails, paths and stage jobs.
    "trail_hops": _raw(trails.trail_hops, with_trail=True),
    "trail_violations": _raw(trails.trail_violations, with_trail=True),
    "untagged_trail_records": _raw(
        lambda raw: raw.where(header_text(wire.TRAIL).isNull())
        .groupBy("kafka_topic")
        .agg(F.count(F.lit(1)).alias("records")),
        with_trail=True,
    ),
    "trace_path": _produce(lambda p: trails.trace_path(p).drop("origin_day")),
    "relay_output": _raw(_relay_output, with_trail=True),
    "started_traces": _raw(_started, with_trail=True),
    "consume_markers": _raw(_markers),
    # Metric queries.
    "k01_avg_latency": _produce(lambda p: meters.average_latency(p, HOP_DIMS)),
    "k02_max_latency": _produce(lambda p: meters.maximum_latency(p, HOP_DIMS)),
    "k03_produce_edges": _produce(lambda p: meters.counted(p, EDGE_DIMS)),
    "k04_hop_counts": _produce(lambda p: meters.counted(p, ["pipeline", "this_topic", "hop_count"])),
    "k05_consume_edges": _latency_of_consumes(
        lambda c: meters.counted(c, ["pipeline", "this_topic", "consumer_service"])
    ),
    "k06_time_to_consume": _latency_of_consumes(lambda c: meters.average_latency(c, CONSUME_DIMS)),
    "k07_consume_age": _latency_of_consumes(
        lambda c: meters.average_latency(c, CONSUME_DIMS).withColumnRenamed("avg_seconds", "avg_age_seconds")
    ),
    "k08_consumer_throughput": _consume(lambda c: meters.counted(c, ["consumer_service"])),
    "k09_failure_ratio": _produce(meters.failure_ratio, "status"),
    "k10_completion_share": _produce(meters.completion_share),
    "k11_lagging_consumers": _consume(meters.lagging_consumers),
    "k12_silent_services": _produce(meters.silent_services, fields=["this_service"]),
    "k12_silent_by_pipeline": _produce(
        lambda p: meters.silent_services(p, dims=["pipeline", "this_service"])
    ),
    "k13_drop_off": _signals(lambda s: meters.drop_off(s, wire.ENRICHED, wire.FULFILLED)),
    "k14_end_to_end_latency": _consume(meters.end_to_end_latency),
    "k15_hop_ceiling": _produce(meters.at_hop_ceiling),
    "k16_pipeline_records": _produce(lambda p: meters.counted(p, ["pipeline"]), fields=["pipeline"]),
    "k17_topic_records": _produce(lambda p: meters.counted(p, ["this_topic"]), fields=["this_topic"]),
    "k18_latency_change": _produce(meters.latency_change),
    "k19_pass_through": _signals(meters.pass_through),
    "k20_new_services": _produce(meters.new_services),
    "k21_pipeline_filter": _produce(
        lambda p: meters.counted(meters.in_pipelines(p, "ord.*"), ["pipeline", "this_service"])
    ),
    "k21_pipelines": _produce(meters.pipelines),
    # Questions.
    "l01_record_tags": _raw(trails.record_tags),
    "l05_relay_survival": _signals(questions.relay_survival),
    "l06_trace_pipeline": _produce(questions.trace_pipeline),
    "l08_service_graph": _consume(questions.service_graph),
    "l12_traces_per_pipeline": _produce(questions.traces_per_pipeline),
    "l13_latency_around": _produce(lambda p: questions.latency_around(p, DEPLOY)),
    "l14_completion": _signals(questions.completion),
    "l15_lost_between": _produce(questions.lost_between),
    "l16_duplicates": _consume(questions.duplicates),
    "l17_unfinished": _produce(questions.unfinished),
    "l19_first_appearance": _produce(questions.first_appearance),
    "l20_pipeline_percentiles": _produce(lambda p: _rounded(questions.pipeline_percentiles(p))),
    "l21_worst_minute": _produce(lambda p: _rounded(questions.worst_minute(p))),
    "l22_topology_drift": _drift,
    "l23_stuck_rate": _produce(lambda p: questions.stuck_rate_around(p, DEPLOY)),
    "l24_stuck_breakdown": _produce(questions.stuck_breakdown, "kafka_partition"),
    "l26_dated_path": _dated_path,
    "l26_one_trace": _looked_up,
    "l27_missed_services": _produce(questions.missed_services),
    "l28_trace_journey": _raw(
        lambda raw: trails.trace_journey(views.signals(raw, fields=["this_service", "this_topic", "hop_count"]))
    ),
    "l29_audit": _signals(questions.audit),
    "l30_correlated": _correlated,
    "l12_traces_across_days": _produce(_distinct_across_days),
    "l15_lost_across_days": _produce(_lost_across_days),
    # The same asked of streams that work off the stored records.
    "stuck_trace_replayed": _raw(replays.stuck),
    "k12_silent_services_replayed": _raw(replays.silent),
    "k13_drop_off_replayed": _raw(replays.drop_off),
    "k20_new_services_replayed": _raw(replays.sightings),
    "l14_completion_replayed": _raw(replays.completion),
    "l29_audit_replayed": _raw(replays.audit),
}
