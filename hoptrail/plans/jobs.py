"""The report job: all reports from one source, in batch or as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hoptrail import wire
from hoptrail.operators import annotate, percentiles, reports, stuck
from hoptrail.operators.views import produced, signals
from hoptrail.session import scratch_path
from hoptrail.sources import files
from hoptrail.streaming import fates, liveness, sinks, spells
from hoptrail.streaming.watermarks import with_watermark


def report_frames(signal_rows: DataFrame, percentile_method: str) -> dict[str, DataFrame]:
    """Every report over the decoded records, by table name."""
    produce = produced(signal_rows)
    return {
        "latency_report_1m": reports.latency(produce),
        "topology_report_1m": reports.topology(produce),
        "bipartite_topology_report_1m": reports.bipartite_topology(signal_rows),
        "hop_distribution_1m": reports.hop_distribution(produce),
        "coverage_report_1m": reports.coverage(produce),
        "stuck_trace_alerts_1m": stuck.stuck_traces(produce),
        "latency_percentiles_flat_1m": percentiles.latency_percentiles(produce, percentile_method),
    }


# Reports that are a selection from another one of the same grain.
DERIVED = {
    "topology_report_1m": ("bipartite_topology_report_1m", reports.topology_of_edges),
    "coverage_report_1m": ("latency_report_1m", reports.coverage_of_latency),
}


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    folder: str,
    landing: str | None = None,
    percentile_method: str = "exact",
) -> list[str]:
    """Write all reports of a table of raw records.

    The records are decoded once into a table in the shared folder. The reports
    read only the columns they need from it, and a lost executor costs a re-read
    of that table, not of the raw records. Two of the reports are read off
    finished ones instead of being counted again.
    """
    landing = landing or scratch_path(spark, "landed")
    files.land(raw, landing)
    frames = report_frames(files.read_landed(spark, landing), percentile_method)
    for name, report in frames.items():
        if name not in DERIVED:
            sinks.write_report(report, name, folder)
    for name, (source, derive) in DERIVED.items():
        sinks.write_report(derive(sinks.read_report(spark, folder, source)), name, folder)
    return list(frames)


def start_report_streams(
    signal_rows: DataFrame,
    folder: str,
    checkpoints: str | None = None,
    percentile_method: str = "kll",
    every: str | None = wire.CHECKPOINT_EVERY,
) -> list[StreamingQuery]:
    """Start one named query per report over watermarked decoded records, each
    with a checkpoint of its own. The records may come from a landing stream,
    which decodes them once for all reports."""
    return [
        sinks.start_report(
            report,
            name,
            folder,
            f"{checkpoints}/{name}" if checkpoints else None,
            every,
        )
        for name, report in report_frames(signal_rows, percentile_method).items()
    ]


def start_streams(
    raw: DataFrame, folder: str, checkpoints: str | None = None, delay: str = wire.WATERMARK_DELAY, **options
) -> list[StreamingQuery]:
    """Start all reports over a stream of raw records."""
    return start_report_streams(signals(with_watermark(raw, delay)), folder, checkpoints, **options)


def start_kafka_reports(
    signal_rows: DataFrame,
    servers: str,
    checkpoints: str,
    percentile_method: str = "kll",
    every: str | None = wire.CHECKPOINT_EVERY,
) -> list[StreamingQuery]:
    """All reports over watermarked decoded records, each to its own topic."""
    return [
        sinks.start_report_to_kafka(report, name, servers, f"{checkpoints}/kafka-{name}", every)
        for name, report in report_frames(signal_rows, percentile_method).items()
    ]


def start_watch_streams(
    signal_rows: DataFrame,
    folder: str,
    checkpoints: str | None = None,
    every: str | None = wire.CHECKPOINT_EVERY,
) -> list[StreamingQuery]:
    """What the reports do not tell, over watermarked decoded records: silent and new
    services, completions, and stuck traces exact on replay, each to its own table."""
    produce = produced(signal_rows)
    frames = {
        "silent_services": liveness.silent_services(produce),
        "new_services": liveness.new_services(produce),
        "completions": fates.completions(signal_rows),
        "stuck_spells": spells.stuck_spells(produce),
    }
    return [
        sinks.start_append(
            frame,
            name,
            f"{folder}/{name}",
            f"{checkpoints}/{name}" if checkpoints else sinks.checkpoint_folder(folder, name),
            every,
        )
        for name, frame in frames.items()
    ]


def start_landed_streams(
    raw: DataFrame,
    folder: str,
    checkpoints: str | None = None,
    delay: str = wire.WATERMARK_DELAY,
    every: str | None = wire.CHECKPOINT_EVERY,
    percentile_method: str = "kll",
) -> list[StreamingQuery]:
    """Land a stream of raw records once and start all reports over the landed table,
    so the source is read and decoded by one query instead of seven."""
    spark, landed = raw.sparkSession, f"{folder}/landed"
    landing = files.start_landing(
        raw, landed, f"{checkpoints}/landing" if checkpoints else sinks.checkpoint_folder(folder, "landing"), every
    )
    if not every:
        landing.awaitTermination()
    rows = with_watermark(files.read_landed(spark, landed, stream=True), delay)
    return [landing, *start_report_streams(rows, folder, checkpoints, percentile_method, every)]


def start_patient_annotation(
    spark: SparkSession,
    folder: str,
    open_model: Callable[[], annotate.Model],
    every: str | None = wire.CHECKPOINT_EVERY,
    **patience,
) -> list[StreamingQuery]:
    """The same, past a model that fails: what was tried goes to one table, each alert
    once, and two streams follow it, to the causes and to the alerts that failed."""
    alerts = sinks.read_report(spark, folder, "stuck_trace_alerts_1m", stream=True)
    asked = annotate.tried(alerts, open_model, **patience)
    started = []

    def start(name: str, frame: DataFrame) -> None:
        query = sinks.start_append(frame, name, f"{folder}/{name}", sinks.checkpoint_folder(folder, name), every)
        if not every:
            query.awaitTermination()
        started.append(query)

    start("trace_rca_tried", asked)
    rows = spark.readStream.schema(asked.schema).parquet(f"{folder}/trace_rca_tried")
    start("trace_rca_1m", annotate.answered(rows))
    start("trace_rca_failed", annotate.failed(rows))
    return started


def start_annotation(
    spark: SparkSession,
    folder: str,
    open_model: Callable[[], annotate.Model],
    checkpoint: str | None = None,
    every: str | None = wire.CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Follow the alert table and write a root cause per alert to its own table."""
    alerts = sinks.read_report(spark, folder, "stuck_trace_alerts_1m", stream=True)
    return sinks.start_report(
        annotate.root_causes(alerts, open_model), "trace_rca_1m", folder, checkpoint, every
    )
