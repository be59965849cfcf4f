"""Operators that split hot groups, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hoptrail.operators import trails
from hoptrail.operators.percentiles import exact_percentiles
from hoptrail.operators.stuck import silent_spells, stuck_traces
from tests.records import START


@pytest.fixture(scope="module")
def hops():
    """One looping trace owns a third of the records."""
    pick = random.Random(7)
    rows = []
    for i in range(3000):
        trace = "hot" if i % 3 == 0 else f"t{pick.randrange(400)}"
        rows.append((trace, START + pick.randrange(3_000_000), pick.randrange(1, 5)))
    rows += [("edge", START, 1), ("edge", START + 59_999, 2), ("edge", START + 119_999, 3)]
    rows += [("slots", START + 59_999, 1), ("slots", START + 60_000, 2), ("slots", START + 119_999, 3)]
    rows += [("tie", START + 5, 1), ("tie", START + 5, 2)]
    return rows


@pytest.fixture(scope="module")
def produce(spark, hops):
    return spark.createDataFrame(hops, "trace_id string, ms bigint, hop_count int").select(
        "trace_id",
        F.timestamp_millis("ms").alias("event_time"),
        "hop_count",
        F.lit("orders").alias("pipeline"),
        F.lit("a").alias("origin_service"),
        F.concat(F.lit("service"), "hop_count").alias("this_service"),
        F.concat(F.lit("topic"), "hop_count").alias("this_topic"),
    )


def by_trace(hops):
    traces = {}
    for trace, ms, hop in hops:
        traces.setdefault(trace, []).append((ms, hop))
    return {trace: sorted(steps) for trace, steps in traces.items()}


def test_stuck_traces(produce, hops):
    expected = set()
    for trace, steps in by_trace(hops).items():
        for at, (ms, hop) in enumerate(steps):
            if at + 1 == len(steps) or steps[at + 1][0] - ms >= 60_000:
                expected.add((trace, ms, hop))
    found = stuck_traces(produce).select("trace_id", "last_seen_ts_ms", "last_hop_count").collect()
    assert len(found) == len(expected)
    assert {tuple(r) for r in found} == expected


def test_gap_of_exactly_a_minute_is_an_alert(produce):
    seen = stuck_traces(produce).where("trace_id = 'edge'").select("last_hop_count").collect()
    assert sorted(r[0] for r in seen) == [2, 3]


def test_terminal_topics_are_left_out(produce):
    kept = stuck_traces(produce, terminal_topics=["topic3"])
    assert kept.where("last_topic = 'topic3'").count() == 0
    assert kept.count() == stuck_traces(produce).where("last_topic <> 'topic3'").count()


def test_positions(produce, hops):
    expected = {
        (trace, pos, *step) for trace, steps in by_trace(hops).items() for pos, step in enumerate(steps, 1)
    }
    found = trails.trace_path(produce).select("trace_id", "pos", "event_ms", "hop_count").collect()
    assert len(found) == len(hops)
    assert {tuple(r) for r in found} == expected


def test_silence_is_broken_by_produced_records_only(produce, hops):
    """Consume markers in between neither end a silence nor start one."""
    markers = produce.withColumn("consumer_service", F.lit("c")).withColumn(
        "event_time", F.col("event_time") + F.expr("interval 25 seconds")
    )
    both = produce.withColumn("consumer_service", F.lit(None).cast("string")).unionByName(markers)
    spells = silent_spells(both, F.count(F.lit(1)).alias("rows"))
    assert spells.agg(F.sum("rows")).first()[0] == 2 * len(hops)
    found = spells.where("silent").select("trace_id", "last.seen_ms")
    expected = stuck_traces(produce).select("trace_id", "last_seen_ts_ms")
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


def interpolated(values, q):
    values = sorted(values)
    at = (len(values) - 1) * q
    low, high = int(at // 1), -int(-at // 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize(
    "values",
    [
        [5],
        [1, 2],
        [0] * 50 + [1],
        list(range(1000)),
        [-5, -3, -1, 0, 2, 9],
        [2**40 + i for i in range(100)] + [-(2**40)],
        [random.Random(3).randrange(-10_000, 100_000) for _ in range(2000)],
    ],
)
def test_exact_percentiles(spark, values):
    data = [(key, v) for key in (None, "a") for v in values] + [("a", None), ("b", None)]
    df = spark.createDataFrame(data, "key string, v bigint")
    found = exact_percentiles(df, ["key"], "v").collect()
    assert {r.key for r in found} == {None, "a"}
    for row in found:
        assert row.sample_count == len(values)
        for q, got in zip((0.5, 0.95, 0.99), (row.p50_ms, row.p95_ms, row.p99_ms)):
            assert got == pytest.approx(interpolated(values, q), rel=1e-12, abs=1e-9)


def test_positions_of_a_minute_with_a_third_of_all_rows(spark):
    """A retry storm: many records of one trace in one minute, with equal rows."""
    pick = random.Random(11)
    rows = [("hot", START + pick.randrange(200), pick.randrange(1, 3)) for _ in range(1000)]
    rows += [(f"t{i % 300}", START + pick.randrange(600_000), 1) for i in range(2000)] + [("hot", None, 1)]
    df = spark.createDataFrame(rows, "trace_id string, event_ms bigint, hop_count int")
    found = sorted((r.trace_id, r.pos, r.event_ms, r.hop_count) for r in trails.in_order(df, ["hop_count"]).collect())
    expected = [
        (trace, pos, *step)
        for trace, steps in by_trace([r for r in rows if r[1] is not None]).items()
        for pos, step in enumerate(steps, 1)
    ]
    assert found == sorted([*expected, ("hot", 1001, None, 1)], key=lambda x: x[:2])


def test_percentiles_far_from_zero(spark):
    """Values with a large common offset still spread over narrow steps."""
    values = [1_704_067_200_000 + random.Random(5).randrange(10**9) + i for i in range(3000)] + [-(2**62), 2**62]
    df = spark.createDataFrame([("a", v) for v in values], "key string, v bigint")
    row = exact_percentiles(df, ["key"], "v").first()
    for q, got in zip((0.5, 0.95, 0.99), (row.p50_ms, row.p95_ms, row.p99_ms)):
        assert got == pytest.approx(interpolated(values, q), rel=1e-12)


def test_positions_cost_one_join(produce):
    plan = trails.trace_path(produce)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
