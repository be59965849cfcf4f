"""Kafka output, repeats, late rows, a failing model, and the command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hoptrail import __main__ as command
from hoptrail import schemas, wire
from hoptrail.operators import annotate, distincts, relay, reports, views
from hoptrail.plans import jobs
from hoptrail.plans.questions import lost_between
from hoptrail.sources import files
from hoptrail.streaming import lateness, once, sinks
from hoptrail.streaming.watermarks import with_watermark
from tests.records import START, frame, golden_chain, record
from tests.test_replays import chain, in_batches
from tests.test_streaming import add_file

ALERT = ("id", "intake", "orders", "svc", "topic", 2, 10, 60_000)


@pytest.fixture
def memory_for_kafka(spark, monkeypatch):
    """What would go to Kafka lands in memory tables named like the queries."""
    monkeypatch.setattr(sinks, "KAFKA", "memory")
    return spark


def run(spark, *argv):
    for query in command.start(spark, command.parser().parse_args([*map(str, argv), "--once"])):
        query.awaitTermination()


def test_reports_go_to_their_topics(memory_for_kafka, tmp_path):
    spark, folder = memory_for_kafka, in_batches(memory_for_kafka, golden_chain(), tmp_path / "raw", 1)
    raw = with_watermark(files.read_raw(spark, folder, stream=True))
    started = jobs.start_kafka_reports(views.signals(raw), "nowhere:1", f"{tmp_path}/checkpoints", every=None)
    for query in started:
        query.awaitTermination()
    assert len(started) == 7
    sent = spark.table("latency_report_1m")
    assert sent.columns == ["topic", "value"]
    rows = [json.loads(r["value"]) for r in sent.collect()]
    assert {r["topic"] for r in sent.collect()} == {wire.REPORT_TOPICS["latency_report_1m"]}
    assert sorted(r["this_topic"] for r in rows) == sorted(wire.STAGE_TOPICS)
    assert set(rows[0]) <= set(schemas.REPORTS["latency_report_1m"].names)


def test_a_stage_sends_to_kafka(memory_for_kafka, tmp_path):
    spark = memory_for_kafka
    add_file(frame(spark, golden_chain()), f"{tmp_path}/raw")
    run(spark, "stage", "--raw", f"{tmp_path}/raw", "--out", tmp_path / "out", "--to-kafka", "nowhere:1",
        "--service", wire.ENRICHMENT, "--topic", wire.PLACED, "--out-topic", wire.ENRICHED)
    sent = spark.table(f"stage_{wire.ENRICHMENT}".replace("-", "_"))
    assert sent.columns == ["topic", "key", "value", "headers"]
    rows = {r["topic"]: r for r in sent.collect()}
    assert set(rows) == {wire.ENRICHED, wire.MARKER_TOPIC}
    assert bytes(rows[wire.ENRICHED]["key"]) == b"key" and rows[wire.MARKER_TOPIC]["value"] is None
    headers = {h["key"]: bytes(h["value"]).decode() for h in rows[wire.ENRICHED]["headers"]}
    assert headers[wire.HOP_COUNT] == "1" and headers[wire.THIS_SERVICE] == wire.ENRICHMENT


def test_command_line_modes(spark, tmp_path):
    folder = in_batches(spark, chain(2, 20), tmp_path / "raw", 1)
    source = ["--raw", folder, "--out"]
    run(spark, "batch", *source, tmp_path / "batch")
    run(spark, "stream", *source, tmp_path / "landed")
    run(spark, "stream", *source, tmp_path / "direct", "--direct")
    batch = sinks.read_report(spark, f"{tmp_path}/batch", "latency_report_1m")
    # The untagged closing record is not landed, so the last minutes stay open there.
    for other, missing in (("landed", 4), ("direct", 0)):
        found = sinks.read_report(spark, f"{tmp_path}/{other}", "latency_report_1m")
        assert found.count() >= batch.count() - missing > 0 and found.exceptAll(batch).count() == 0
    run(spark, "watch", *source, tmp_path / "watch")
    stuck = spark.read.parquet(f"{tmp_path}/watch/stuck_spells")
    assert stuck.exceptAll(sinks.read_report(spark, f"{tmp_path}/batch", "stuck_trace_alerts_1m")).count() == 0
    assert spark.read.parquet(f"{tmp_path}/watch/completions").count() >= 20
    assert spark.read.parquet(f"{tmp_path}/watch/new_services").where("first").count() == 3
    run(spark, "annotate", "--out", tmp_path / "batch", "--model", "tests.test_delivery:open_calm_model")
    assert spark.read.parquet(f"{tmp_path}/batch/trace_rca_failed").count() == 0
    with pytest.raises(SystemExit):
        run(spark, "stage", *source, tmp_path / "x")
    with pytest.raises(SystemExit):
        run(spark, "batch", "--out", tmp_path / "x")


def test_a_watermark_per_topic_from_the_command_line(spark, tmp_path):
    """An idle topic holds reports back, as documented; with all topics moving they come."""
    closing = [record(START + 86_400_000, topic=t, trace="f" * 32) for t in wire.STAGE_TOPICS]
    closing.append(record(START + 86_400_000, trace="f" * 32, consumer=wire.SHIPPING))
    for name, rows in (("idle", golden_chain()[:1]), ("all", golden_chain() + closing)):
        add_file(frame(spark, rows), f"{tmp_path}/{name}")
        run(spark, "stream", "--raw", f"{tmp_path}/{name}", "--out", tmp_path / f"{name}-out", "--watermark-each")
    assert sinks.read_report(spark, f"{tmp_path}/idle-out", "latency_report_1m").count() == 0
    assert sinks.read_report(spark, f"{tmp_path}/all-out", "latency_report_1m").count() == 3


def open_calm_model():
    return lambda asked: ["It stopped. Restart it."] * len(asked)


def streamed(df, name, tmp_path, spark):
    sinks.start_append(df, name, f"{tmp_path}/{name}", f"{tmp_path}/checkpoint-{name}", None).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")


def test_a_repeated_batch_reaches_the_next_stage_once(spark, tmp_path):
    placed = frame(spark, [record(START + i, trace=f"{i:032x}") for i in range(5)]).where(F.lit(True))
    sent = relay.stage_output(placed, wire.ENRICHMENT, wire.ENRICHED)
    for offset in (0, 100):  # written twice, as a sink does after a failure, under new offsets
        again = sent.withColumn("kafka_partition", F.lit(0)).withColumn("kafka_offset", offset + F.monotonically_increasing_id())
        add_file(again.select(*schemas.RAW.names), f"{tmp_path}/raw")
    stream = files.read_raw(spark, f"{tmp_path}/raw", stream=True, files_per_trigger=1)
    found = streamed(once.by_content(stream), "content", tmp_path, spark)
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 20
    assert found.count() == 10 and found.columns == schemas.RAW.names
    assert views.produce_view(found).select("trace_id").distinct().count() == 5
    assert streamed(once.by_coordinates(stream), "coordinates", tmp_path, spark).count() == 20


def test_a_log_read_twice_comes_through_once(spark, tmp_path):
    rows = [record(START + i, trace=f"{i:032x}") for i in range(4)] + [record(START + 9, trace=None)]
    for _ in range(2):
        add_file(frame(spark, rows), f"{tmp_path}/raw")
    stream = files.read_raw(spark, f"{tmp_path}/raw", stream=True, files_per_trigger=1)
    for name, operator in (("coordinates", once.by_coordinates), ("content", once.by_content)):
        assert streamed(operator(stream), name, tmp_path, spark).count() == 5


def test_late_rows_are_counted(spark, tmp_path):
    listener = lateness.LateRows()
    spark.streams.addListener(listener)
    steps = [
        [record(START + 1000), record(START + 200_000)],
        [record(START + 201_000)],
        [record(START + i, trace=f"{i:032x}") for i in (1, 2, 3)],
        [record(START + 86_400_000)],
    ]
    for rows in steps:
        add_file(frame(spark, rows), f"{tmp_path}/raw")
    stream = files.read_raw(spark, f"{tmp_path}/raw", stream=True, files_per_trigger=1)
    report = reports.coverage(views.produce_view(with_watermark(stream)))
    query = sinks.start_report(report, "coverage_report_1m", f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None)
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert lateness.dropped_rows(query) == 3
    assert listener.report(spark).where("query = 'coverage_report_1m'").first()["late_rows"] == 3
    assert sinks.read_report(spark, f"{tmp_path}/out", "coverage_report_1m").agg(F.sum("records")).first()[0] == 3
    spark.streams.removeListener(listener)


def test_a_failing_model_loses_no_alert(spark, tmp_path):
    def open_model():
        calls = [0]

        def answer(asked):
            calls[0] += 1
            if calls[0] % 3 == 0 or any("trace_id=bad" in p for p in asked):
                raise TimeoutError("no answer")
            return ["It stopped. Restart it."] * len(asked)

        return answer

    rows = [(f"id{i}", *ALERT[1:]) for i in range(60)] + [("id7", *ALERT[1:])] * 3
    rows += [(f"bad{i}", *ALERT[1:]) for i in range(3)] + [("nil", "intake", None, *ALERT[3:])]
    alerts = spark.createDataFrame(rows, schemas.REPORTS["stuck_trace_alerts_1m"])
    sinks.write_report(alerts, "stuck_trace_alerts_1m", str(tmp_path))
    jobs.start_patient_annotation(spark, str(tmp_path), open_model, None, parallelism=2, first_wait=0.001)
    causes = sinks.read_report(spark, str(tmp_path), "trace_rca_1m").collect()
    failed = spark.read.parquet(f"{tmp_path}/trace_rca_failed").collect()
    assert len(causes) + len(failed) == len(rows)
    assert sorted(r["trace_id"] for r in failed) == ["bad0", "bad1", "bad2"]
    assert all("TimeoutError: no answer" in r["failure"] and r["last_hop_count"] == 2 for r in failed)
    assert sum(r["root_cause"] is None for r in causes) == 1


def test_equal_prompts_are_asked_once_and_waits_grow(monkeypatch):
    waits = []
    monkeypatch.setattr(annotate.time, "sleep", waits.append)

    def never(asked):
        raise ValueError("no")

    assert annotate.patiently(never, ["a"], 4, 0.5) == ([None], "ValueError: no")
    assert waits == [0.5, 1.0, 2.0]
    assert annotate.patiently(lambda asked: ["x"], ["a", "b"], 1, 0)[1].startswith("ValueError: 1 answers")


def test_equal_prompts_meet(spark):
    def open_model():
        seen = []

        def answer(asked):
            assert len(set(asked)) == len(asked) and not set(asked) & set(seen)
            seen.extend(asked)
            return [f"Asked {p[-3:]}. Done." for p in asked]

        return answer

    rows = [(f"id{i % 4}", *ALERT[1:]) for i in range(40)]
    found = annotate.tried(spark.createDataFrame(rows, schemas.REPORTS["stuck_trace_alerts_1m"]), open_model).collect()
    assert len(found) == 40 and all(r["failure"] is None and r["root_cause"] for r in found)


def test_sketches_unite_and_differ_within_their_error(spark):
    day = 86_400_000
    rows = [record(START + (i % 3) * day + i, trace=f"{i:032x}") for i in range(30_000)]
    rows += [record(START + (i % 2) * day + i, trace=f"{i:032x}", topic=wire.ENRICHED) for i in range(0, 30_000, 3)]
    produce = views.produce_view(frame(spark, rows))
    sketches = distincts.trace_sketches(produce)
    assert sketches.count() == 5
    total = distincts.distinct_traces(sketches, ["pipeline"]).first()["distinct_traces"]
    assert 0 < abs(total - 30_000) <= 30_000 * distincts.ERROR
    found, exact = (x.first() for x in (distincts.lost_between(sketches, wire.STAGE_TOPICS[:2]), lost_between(produce, wire.STAGE_TOPICS[:2])))
    assert exact["lost"] == 20_000
    assert abs(found["lost"] - 20_000) <= 30_000 * distincts.ERROR
