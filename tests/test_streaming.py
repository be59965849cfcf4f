"""Streams give what batch gives, survive a restart and drop what is late."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from hoptrail import schemas, wire
from hoptrail.operators import meters, reports, views
from hoptrail.plans import jobs
from hoptrail.sources import files
from hoptrail.sources.events import raw_records
from hoptrail.streaming import sinks
from hoptrail.streaming.arrival import stuck_by_arrival
from hoptrail.streaming.watermarks import watermark_each, with_watermark
from tests.records import START, frame, record

SEVEN = [name for name in schemas.REPORTS if name != "trace_rca_1m"]
FLUSH = START + 4 * 86_400_000


def add_file(df, folder):
    """One more file, newer than all before it."""
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df.coalesce(1).write.mode("append").parquet(folder)
    for name in set(os.listdir(folder)) - before:
        os.utime(os.path.join(folder, name), (START // 1000 + len(before),) * 2)


def flush(spark):
    return frame(spark, [record(FLUSH, trace="f" * 32)])


def run(report, name, tmp_path):
    query = sinks.start_report(report, name, f"{tmp_path}/out", f"{tmp_path}/checkpoint/{name}", every=None)
    query.awaitTermination()
    return sinks.read_report(report.sparkSession, f"{tmp_path}/out", name)


@pytest.fixture(scope="module")
def ran(spark, small, tmp_path_factory):
    """All reports of the small tables, streamed in four files and in batch."""
    folder = str(tmp_path_factory.mktemp("reports"))
    raw = raw_records(spark, small).select(*schemas.RAW.names).persist()
    quarter = (F.unix_millis("event_time") - START).cast("bigint") / (12 * 3_600_000 / 4)
    for i in range(4):
        part = raw.where(quarter < 1) if i == 0 else raw.where((quarter >= i) & ((quarter < i + 1) | F.lit(i == 3)))
        add_file(part, f"{folder}/raw")
    add_file(flush(spark), f"{folder}/raw")
    stream = files.read_raw(spark, f"{folder}/raw", stream=True, files_per_trigger=1)
    for query in jobs.start_streams(stream, f"{folder}/stream", f"{folder}/checkpoints",
                                    percentile_method="approx", every=None):
        query.awaitTermination()
    jobs.run_batch(spark, raw, f"{folder}/batch", f"{folder}/landed", percentile_method="approx")
    raw.unpersist()
    return folder


@pytest.mark.parametrize("name", SEVEN)
def test_stream_equals_batch(spark, ran, name):
    streamed = sinks.read_report(spark, f"{ran}/stream", name)
    batch = sinks.read_report(spark, f"{ran}/batch", name)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_reports_serve_ad_hoc_sql(spark, ran):
    sinks.register_reports(spark, f"{ran}/batch", *SEVEN)
    assert spark.sql("select max(max_latency_ms) from latency_report_1m").first()[0] > 0


def test_alerts_are_annotated_from_their_table(spark, ran, tmp_path):
    def open_model():
        return lambda asked: ["It stopped. Restart it."] * len(asked)

    alerts = sinks.read_report(spark, f"{ran}/batch", "stuck_trace_alerts_1m")
    sinks.write_report(alerts, "stuck_trace_alerts_1m", str(tmp_path))
    jobs.start_annotation(spark, str(tmp_path), open_model, f"{tmp_path}/checkpoint", every=None).awaitTermination()
    notes = sinks.read_report(spark, str(tmp_path), "trace_rca_1m")
    assert notes.count() == alerts.count()
    assert notes.where("root_cause is null").count() == alerts.where("pipeline is null").count()


def test_landed_days_are_pruned(spark, ran):
    landed = files.landed_days(files.read_landed(spark, f"{ran}/landed"), "2024-01-01", "2024-01-01")
    plan = reports.coverage(views.produced(landed))._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "value" not in scan.split("ReadSchema")[1] and "hop_count" not in scan.split("ReadSchema")[1]
    assert "IsNull(consumer_service)" in scan


def test_reports_stream_from_the_landing(spark, ran, tmp_path):
    raw = files.read_raw(spark, f"{ran}/raw", stream=True, files_per_trigger=1)
    files.start_landing(raw, f"{tmp_path}/landed", f"{tmp_path}/landing", every=None).awaitTermination()
    landed = with_watermark(files.read_landed(spark, f"{tmp_path}/landed", stream=True))
    for query in jobs.start_report_streams(landed, f"{tmp_path}/out", f"{tmp_path}/checkpoints", every=None):
        query.awaitTermination()
    for name in ("latency_report_1m", "stuck_trace_alerts_1m"):
        found = sinks.read_report(spark, f"{tmp_path}/out", name)
        batch = sinks.read_report(spark, f"{ran}/batch", name)
        assert found.count() == batch.count()
        assert found.exceptAll(batch).count() == 0


def test_metric_queries_stream_in_update_mode(spark, tmp_path):
    """A live board does not wait for the watermark."""
    add_file(frame(spark, [record(START), record(START + 1000, origin=START + 500)]), f"{tmp_path}/raw")
    stream = views.produce_view(with_watermark(files.read_raw(spark, f"{tmp_path}/raw", stream=True)))
    for name, board in {
        "counted": meters.counted(stream, ["this_topic"]),
        "average": meters.average_latency(stream, ["this_topic"]),
        "maximum": meters.maximum_latency(stream, ["this_topic"]),
    }.items():
        query = (
            board.writeStream.outputMode("update").format("memory").queryName(name)
            .option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    found = spark.table("counted").join(spark.table("average"), ["window_start", "this_topic"]).join(
        spark.table("maximum"), ["window_start", "this_topic"]
    )
    assert [tuple(r) for r in found.collect()] == [(START, wire.PLACED, 2, 0.25, 0.5)]


def test_restart_continues(spark, tmp_path):
    folder = f"{tmp_path}/raw"
    add_file(frame(spark, [record(START), record(START + 1000)]), folder)
    stream = files.read_raw(spark, folder, stream=True)

    def report():
        return reports.coverage(views.produce_view(with_watermark(stream)))

    assert run(report(), "coverage_report_1m", tmp_path).count() == 0
    add_file(frame(spark, [record(START + 2000, trace="b" * 32)]), folder)
    assert run(report(), "coverage_report_1m", tmp_path).count() == 0
    add_file(flush(spark), folder)
    rows = run(report(), "coverage_report_1m", tmp_path).collect()
    assert [(r.window_start, r.distinct_traces, r.records) for r in rows] == [(START, 2, 3)]


def test_late_records_are_dropped(spark, tmp_path):
    """A window closes with the batch after the one that moved the watermark."""
    folder = f"{tmp_path}/raw"
    for records in (
        [record(START + 1000), record(START + 70_000)],
        [record(START + 71_000)],
        [record(START + 2000)],
        [record(START + 200_000)],
        [record(FLUSH)],
    ):
        add_file(frame(spark, records), folder)
    stream = files.read_raw(spark, folder, stream=True, files_per_trigger=1)
    rows = run(reports.coverage(views.produce_view(with_watermark(stream))), "coverage_report_1m", tmp_path)
    assert {r.window_start: r.records for r in rows.collect()} == {
        START: 1, START + 60_000: 2, START + 180_000: 1,
    }


def test_a_single_window_stays_open(spark, tmp_path):
    add_file(frame(spark, [record(START + i) for i in range(50)]), f"{tmp_path}/raw")
    stream = files.read_raw(spark, f"{tmp_path}/raw", stream=True)
    assert run(reports.coverage(views.produce_view(with_watermark(stream))), "coverage_report_1m", tmp_path).count() == 0


def test_idle_topic_holds_results_back_with_a_watermark_each(spark, tmp_path):
    add_file(frame(spark, [record(START), record(FLUSH)]), f"{tmp_path}/busy")
    add_file(frame(spark, []), f"{tmp_path}/idle")

    def topic(name):
        return files.read_raw(spark, f"{tmp_path}/{name}", stream=True)

    each = views.produce_view(watermark_each(topic("busy"), topic("idle")))
    both = views.produce_view(with_watermark(views.fan_in(topic("busy"), topic("idle"))))
    assert run(reports.coverage(each), "coverage_report_1m", tmp_path / "each").count() == 0
    assert run(reports.coverage(both), "coverage_report_1m", tmp_path / "both").count() == 1


def test_stuck_by_arrival_keeps_the_last_arrival(spark, tmp_path):
    folder = f"{tmp_path}/raw"
    steps = [
        [record(START + 5000, topic=wire.ENRICHED, hop=2)],
        [record(START + 1000, hop=1)],
        [record(START + 62_000, trace="b" * 32)],
        [record(FLUSH, trace="c" * 32)],
        [record(FLUSH + 1000, trace="c" * 32)],
    ]
    for records in steps:
        add_file(frame(spark, records), folder)
    stream = files.read_raw(spark, folder, stream=True, files_per_trigger=1)
    alerts = run(stuck_by_arrival(views.produce_view(with_watermark(stream))), "stuck_trace_alerts_1m", tmp_path)
    assert {(r.trace_id[0], r.last_topic, r.last_seen_ts_ms, r.stuck_for_ms) for r in alerts.collect()} == {
        ("0", wire.PLACED, START + 1000, 60_000),
        ("b", wire.PLACED, START + 62_000, 60_000),
    }


def report_of(spark, raw):
    return reports.coverage(views.produce_view(with_watermark(files.read_raw(spark, raw, stream=True))))


def finish(report, out, **options):
    sinks.start_report(report, "coverage_report_1m", out, every=None, **options).awaitTermination()
    return sinks.read_report(report.sparkSession, out, "coverage_report_1m")


def test_default_checkpoints_survive_restarts_and_keep_jobs_apart(spark, tmp_path):
    add_file(frame(spark, [record(START)]), f"{tmp_path}/a")
    add_file(flush(spark), f"{tmp_path}/a")
    assert finish(report_of(spark, f"{tmp_path}/a"), f"{tmp_path}/x").count() == 1
    add_file(frame(spark, [record(FLUSH + 120_000)]), f"{tmp_path}/a")
    add_file(frame(spark, [record(FLUSH + 600_000)]), f"{tmp_path}/a")
    assert finish(report_of(spark, f"{tmp_path}/a"), f"{tmp_path}/x").count() == 3
    add_file(frame(spark, [record(START), record(START + 60_000)]), f"{tmp_path}/b")
    add_file(flush(spark), f"{tmp_path}/b")
    assert finish(report_of(spark, f"{tmp_path}/b"), f"{tmp_path}/y").count() == 2


def test_a_new_checkpoint_on_a_filled_table_is_refused(spark, tmp_path):
    add_file(frame(spark, [record(START)]), f"{tmp_path}/a")
    add_file(flush(spark), f"{tmp_path}/a")
    finish(report_of(spark, f"{tmp_path}/a"), f"{tmp_path}/x")
    with pytest.raises(ValueError, match="another checkpoint"):
        finish(report_of(spark, f"{tmp_path}/a"), f"{tmp_path}/x", checkpoint=f"{tmp_path}/fresh")


def test_the_job_lands_once_and_reports_from_there(spark, ran, tmp_path):
    raw = files.read_raw(spark, f"{ran}/raw", stream=True, files_per_trigger=1)
    for query in jobs.start_landed_streams(raw, str(tmp_path), every=None):
        query.awaitTermination()
    found = sinks.read_report(spark, str(tmp_path), "latency_report_1m")
    assert found.exceptAll(sinks.read_report(spark, f"{ran}/batch", "latency_report_1m")).count() == 0
    assert found.count() == sinks.read_report(spark, f"{ran}/batch", "latency_report_1m").count()
