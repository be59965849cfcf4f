"""The golden chain, and records the reports must get right."""

from __future__ import annotations

import pytest

from hoptrail import schemas, wire
from hoptrail.operators import reports, views
from hoptrail.plans.jobs import report_frames
from tests.records import START, TRACE, frame, golden_chain, headers, record, when

END = START + 60_000


@pytest.fixture(scope="module")
def golden(spark):
    return report_frames(views.signals(frame(spark, golden_chain())), "exact")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_schemas(golden):
    for name, report in golden.items():
        schemas.conform(report, schemas.REPORTS[name])


def test_latency(golden):
    assert rows(golden["latency_report_1m"], "max_latency_ms") == [
        (START, END, "orders", wire.INTAKE, topic, 1, 1, float(ms), ms, ms)
        for topic, ms in zip(wire.STAGE_TOPICS, (0, 500, 1500))
    ]


def test_topology(golden):
    assert rows(golden["topology_report_1m"], "topic") == sorted(
        [
            (START, END, "orders", wire.INTAKE, service, topic, 1, 1)
            for service, topic in zip(wire.CHAIN, wire.STAGE_TOPICS)
        ],
        key=lambda r: r[5],
    )


def test_bipartite_topology_has_three_edges_each_way(golden):
    found = set(rows(golden["bipartite_topology_report_1m"]))
    produce = {
        (START, END, "orders", "produce", s, t, None, wire.INTAKE, 1, 1)
        for s, t in zip(wire.CHAIN, wire.STAGE_TOPICS)
    }
    consume = {
        (START, END, "orders", "consume", None, t, s, wire.INTAKE, 1, 1)
        for s, t in zip(wire.CHAIN[1:], wire.STAGE_TOPICS)
    }
    assert found == produce | consume


def test_hop_distribution(golden):
    assert rows(golden["hop_distribution_1m"], "hop_count") == [
        (START, END, "orders", topic, hop, 1, 1) for hop, topic in enumerate(wire.STAGE_TOPICS, 1)
    ]


def test_coverage(golden):
    assert {r[3]: r[5:] for r in rows(golden["coverage_report_1m"])} == {
        topic: (1, 1) for topic in wire.STAGE_TOPICS
    }


def test_stuck(golden):
    assert rows(golden["stuck_trace_alerts_1m"]) == [
        (TRACE, wire.INTAKE, "orders", wire.FULFILLMENT, wire.FULFILLED, 3, START + 1500, 60_000)
    ]


def test_percentiles(golden):
    assert rows(golden["latency_percentiles_flat_1m"], "p50_ms") == [
        (START, END, "orders", wire.INTAKE, topic, ms, ms, ms, 1)
        for topic, ms in zip(wire.STAGE_TOPICS, (0.0, 500.0, 1500.0))
    ]


def test_record_without_trace_is_invisible(spark):
    raw = frame(spark, [record(START, trace=None), (None, None, when(START), wire.PLACED, 0, 1)])
    assert views.signals(raw).count() == 0


def test_last_of_repeated_headers_counts(spark):
    again = headers(pipeline="late", hop_count=7)
    row = views.produce_view(frame(spark, [record(START, extra=again)])).first()
    assert (row.pipeline, row.hop_count) == ("late", 7)


def test_null_valued_header_is_a_null(spark):
    raw = frame(spark, [record(START, extra=headers(pipeline=None))])
    assert views.produce_view(raw).first().pipeline is None


@pytest.mark.parametrize("origin", ["bad", "", "9" * 30, "1.5e"])
def test_unreadable_origin_gives_null_latency(spark, origin):
    raw = frame(spark, [record(START, origin=origin)])
    row = reports.latency(views.produce_view(raw)).first()
    assert row.sample_count == 1
    assert (row.avg_latency_ms, row.min_latency_ms, row.max_latency_ms) == (None, None, None)
    assert views.rejected_headers(raw).first().bad_origin_ts == 1


def test_latency_that_does_not_fit_is_null(spark):
    raw = frame(spark, [record(START, origin=-(2**63))])
    assert views.produce_view(raw).first().latency_ms is None
    assert views.trace_age(views.produce_view(raw), START).first().age_ms is None


def test_null_pipeline_is_a_group(spark):
    raw = frame(spark, [record(START, pipeline=None), record(START + 1, pipeline=None)])
    row = reports.latency(views.produce_view(raw)).first()
    assert (row.pipeline, row.sample_count, row.distinct_traces) == (None, 2, 1)


def test_clock_skew_is_kept(spark):
    raw = frame(spark, [record(START, origin=START + 40)])
    assert views.produce_view(raw).first().latency_ms == -40


def test_window_boundaries(spark):
    raw = frame(spark, [record(START - 1), record(START), record(END - 1), record(END)])
    found = rows(reports.coverage(views.produce_view(raw)).select("window_start", "records"), "window_start")
    assert found == [(START - 60_000, 1), (START, 2), (END, 1)]


def test_windows_before_1970(spark):
    raw = frame(spark, [record(0), record(1)]).selectExpr(
        "value", "headers", "event_time - interval 1 second as event_time",
        "kafka_topic", "kafka_partition", "kafka_offset",
    )
    row = reports.coverage(views.produce_view(raw)).first()
    assert (row.window_start, row.window_end, row.records) == (-60_000, 0, 2)


def test_conform_rejects_another_schema(spark):
    with pytest.raises(ValueError):
        schemas.conform(spark.range(1), schemas.REPORTS["latency_report_1m"])
