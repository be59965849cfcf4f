"""Stage jobs: traces grow hop by hop and leave markers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.functions import ids
from hoptrail.functions.windows import event_ms
from hoptrail.operators import relay, trails, views
from hoptrail.streaming.stages import run_stage
from hoptrail.sources.files import read_raw
from tests.records import START, frame, headers, when


def later(ms):
    return event_ms() + F.lit(ms)


@pytest.fixture(scope="module")
def untagged(spark):
    return frame(spark, [(b"one", None, when(START), wire.PLACED, 0, 1), (b"two", [("other", b"x")], when(START), wire.PLACED, 0, 2)])


@pytest.fixture(scope="module")
def started(untagged):
    return relay.start_traces(untagged, wire.INTAKE, wire.PLACED)


def header_dict(row):
    return {h.key: h.value.decode() for h in row.headers}


def test_first_hop_is_stamped(started):
    for row in started.collect():
        found = header_dict(row)
        trail = json.loads(found[wire.TRAIL])
        assert trail["h"] == [{"s": wire.INTAKE, "t": wire.PLACED, "m": START}]
        assert (trail["s"], trail["p"], trail["o"], trail["x"]) == (wire.INTAKE, "orders", START, False)
        assert found[wire.HOP_COUNT] == "1" and found[wire.ORIGIN_TS] == str(START)
        assert len(found[wire.TRACE_ID]) == 32 and found[wire.TRACE_ID][12] == "7"
        assert found[wire.TRACE_ID][16] in "89ab"
        assert row.value in (b"one", b"two")
    assert len({header_dict(r)[wire.TRACE_ID] for r in started.collect()}) == 2


def test_replay_gives_the_same_ids(untagged, started):
    again = relay.start_traces(untagged, wire.INTAKE, wire.PLACED)
    assert {header_dict(r)[wire.TRACE_ID] for r in again.collect()} == {
        header_dict(r)[wire.TRACE_ID] for r in started.collect()
    }


def test_other_headers_are_kept(started):
    assert sum("other" in header_dict(r) for r in started.collect()) == 1


def test_three_stages(started):
    second = relay.relay(started, wire.ENRICHMENT, wire.ENRICHED, sent_ms=later(400))
    third = relay.relay(second, wire.FULFILLMENT, wire.FULFILLED, sent_ms=later(900))
    first_id = {r.trace_id for r in views.produce_view(started).collect()}
    for row in views.produce_view(third).collect():
        assert row.trace_id in first_id
        assert (row.origin_service, row.this_service, row.this_topic) == (wire.INTAKE, wire.FULFILLMENT, wire.FULFILLED)
        assert (row.hop_count, row.latency_ms) == (3, 1300)
    hops = trails.trail_hops(third).groupBy("trace_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "service", "topic", "ts_ms"))).alias("hops")
    )
    for row in hops.collect():
        assert [tuple(h) for h in row.hops] == [
            (1, wire.INTAKE, wire.PLACED, START),
            (2, wire.ENRICHMENT, wire.ENRICHED, START + 400),
            (3, wire.FULFILLMENT, wire.FULFILLED, START + 1300),
        ]
    violations = trails.trail_violations(third).first()
    assert violations.trails == 2
    assert sum(violations[name] for name in violations.__fields__[2:]) == 0


def test_markers_describe_producer_and_consumer(started):
    rows = relay.consume_markers(started, wire.ENRICHMENT, sent_ms=later(10)).collect()
    assert len(rows) == 2
    for row in rows:
        found = header_dict(row)
        assert row.value is None and wire.TRAIL not in found
        assert set(found) == {*wire.SCALAR_HEADERS, wire.CONSUMER_SERVICE}
        assert found[wire.CONSUMER_SERVICE] == wire.ENRICHMENT
        assert (found[wire.THIS_SERVICE], found[wire.THIS_TOPIC]) == (wire.INTAKE, wire.PLACED)


def test_untraced_records_leave_no_marker(untagged):
    assert relay.consume_markers(untagged, wire.ENRICHMENT).count() == 0


def test_marker_key_is_null(started):
    row = relay.consume_markers(started.withColumn("key", F.lit(b"k")), wire.ENRICHMENT).first()
    assert row.key is None
    assert relay.relay(started.withColumn("key", F.lit(b"k")), wire.ENRICHMENT, wire.ENRICHED).first().key == b"k"


def trail_of(count, cut=False):
    return json.dumps(
        {"t": "AYzCUfQAcAAAAAAAAAAAKg==", "o": START, "s": wire.INTAKE, "p": "orders",
         "h": [{"s": f"s{i}", "t": "t", "m": START + i} for i in range(count)], "x": cut}
    )


@pytest.mark.parametrize("count,cut,first,size,marked", [
    (30, False, "s0", 31, False),
    (31, False, "s0", 32, False),
    (32, False, "s1", 32, True),
    (32, True, "s1", 32, True),
    (3, True, "s0", 4, True),
])
def test_oldest_hop_goes_at_the_cap(spark, count, cut, first, size, marked):
    raw = frame(spark, [(None, headers(trail=trail_of(count, cut)), when(START), wire.PLACED, 0, 1)])
    row = trails.trails(relay.relay(raw, "next", "out")).first()
    assert (row.hops[0].s, row.hops[-1].s, len(row.hops), row.truncated) == (first, "next", size, marked)
    assert views.produce_view(relay.relay(raw, "next", "out")).first().hop_count == size


def test_ids(spark):
    """The sample id: bytes, hex digits and time agree."""
    row = spark.range(1).select(
        ids.id_from_base64(F.lit("AZ69OS8OeG+9zufGfF2sbw==")).alias("id"),
        ids.id_to_base64(F.lit("019ebd392f0e786fbdcee7c67c5dac6f")).alias("text"),
        ids.id_origin_ms(F.lit("019ebd392f0e786fbdcee7c67c5dac6f")).alias("ms"),
        ids.id_from_base64(F.lit("not base64!")).alias("bad"),
    ).first()
    assert tuple(row) == ("019ebd392f0e786fbdcee7c67c5dac6f", "AZ69OS8OeG+9zufGfF2sbw==", 1781291101966, None)


def test_broken_trail_is_no_trail(spark):
    raw = frame(spark, [(None, headers(trail="{oops"), when(START), wire.PLACED, 0, 1)])
    assert trails.trails(raw).count() == 0


@pytest.mark.parametrize("text", ["{oops", '{"t": "not base64!", "o": 1, "h": [{"s": "a", "t": "b", "m": 1}]}'])
def test_unreadable_trail_starts_a_new_one(spark, text):
    raw = frame(spark, [(None, headers(trail=text), when(START), wire.PLACED, 0, 1)])
    row = trails.trails(relay.relay(raw, "next", "out")).first()
    assert (row.origin_service, row.origin_ts_ms, len(row.hops), row.truncated) == ("next", START, 1, False)
    assert len(row.trace_id) == 32


def test_stage_as_a_stream(spark, started, tmp_path):
    started.write.parquet(f"{tmp_path}/in")
    query = run_stage(
        read_raw(spark, f"{tmp_path}/in", stream=True), wire.ENRICHMENT, wire.ENRICHED,
        f"{tmp_path}/out", f"{tmp_path}/checkpoint", sent_ms=later(400), every=None,
    )
    query.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    sent, markers = (out.where(F.col("kafka_topic") == t) for t in (wire.ENRICHED, wire.MARKER_TOPIC))
    assert [r.hop_count for r in views.produce_view(sent).collect()] == [2, 2]
    assert {r.consumer_service for r in views.consume_view(markers).collect()} == {wire.ENRICHMENT}


def test_terminal_stage_only_leaves_markers(spark, started, tmp_path):
    started.write.parquet(f"{tmp_path}/in")
    run_stage(
        read_raw(spark, f"{tmp_path}/in", stream=True), wire.SHIPPING, None,
        f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None,
    ).awaitTermination()
    assert {r.kafka_topic for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {wire.MARKER_TOPIC}
