"""Exact answers from streams, however the records are cut into batches."""

from __future__ import annotations

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.operators import meters, stuck
from hoptrail.operators.views import produced, signals
from hoptrail.plans import questions, replays
from hoptrail.sources import files
from hoptrail.streaming import fates, liveness, spells
from tests.records import START, frame, record

MINUTE = wire.WINDOW_MS


def in_batches(spark, records, folder, batches):
    """Records in order of time, cut into files that are read one after the other, and
    a last untagged one that moves the watermark."""
    ordered = sorted(records, key=lambda r: r[2])
    rows = frame(spark, ordered).withColumn("turn", F.floor(F.unix_millis("event_time")))
    times = [r[2].timestamp() * 1000 for r in ordered]
    edges = [times[len(times) * i // batches] for i in range(batches)]
    turn = sum(F.when(F.col("turn") >= e, 1).otherwise(0) for e in edges)
    rows.withColumn("turn", turn).coalesce(1).write.partitionBy("turn").parquet(f"{folder}/records")
    frame(spark, [record(int(times[-1]) + 86_400_000, trace=None)]).coalesce(1).write.parquet(f"{folder}/closing")
    for path in glob.glob(f"{folder}/records/turn=*/*.parquet"):
        os.utime(path, (START // 1000 + int(path.split("turn=")[1].split("/")[0]),) * 2)
    return str(folder)


def run(spark, folder, build, out, batches):
    stream = replays._signals(spark, folder, wire.WATERMARK_DELAY, 1 if batches > 1 else None)
    found = replays._worked_off(build(stream), "out", str(out))
    query = [q for q in spark.streams.active]
    assert not query
    return found


def same(found, expected):
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
    assert found.count() > 0


def restless(seed, traces=30):
    """Traces with silences below, at and above the limit, and repeated moments."""
    rng, out = random.Random(seed), []
    for i in range(traces):
        at = START + rng.randint(0, 3_000_000)
        for hop in range(1, rng.randint(2, 7)):
            topic, service = rng.choice(wire.STAGE_TOPICS), rng.choice(wire.CHAIN[:3])
            out.append(record(at, trace=f"{i:032x}", topic=topic, service=service, hop=hop,
                              pipeline=rng.choice(["orders", None])))
            at += rng.choice([0, 1, 59_999, 60_000, 60_001, 30_000, 400_000])
    return out


@pytest.mark.parametrize("batches", [1, 40])
def test_stuck_traces_in_any_number_of_batches(spark, tmp_path, batches):
    folder = in_batches(spark, restless(3), tmp_path / "raw", batches)
    batch = produced(signals(files.read_raw(spark, f"{folder}/records")))
    found = run(spark, folder, lambda s: spells.stuck_spells(produced(s)), tmp_path / "out", batches)
    same(found, stuck.stuck_traces(batch))
    last = run(spark, folder, lambda s: spells.stuck_spells(produced(s), terminal_topics=[wire.FULFILLED]),
               tmp_path / "last", 1)
    same(last, stuck.stuck_traces(batch, terminal_topics=[wire.FULFILLED]))


def test_spells_in_any_order():
    rng = random.Random(5)
    for _ in range(200):
        moments = [rng.randint(0, 12) * 10 for _ in range(rng.randint(1, 12))]
        records = [(m, rng.choice([None, 1, 2]), "t", None, "o", "p") for m in moments]
        held = []
        for r in rng.sample(records, len(records)):
            held = spells.joined(held, r, 30)
        expected = []
        for m in sorted(set(moments)):
            if expected and m - expected[-1][1] < 30:
                expected[-1][1] = m
            else:
                expected.append([m, m])
        assert [[first, last[0]] for first, last in held] == expected
        for _, last in held:
            at_once = [r for r in records if r[0] == last[0]]
            assert last == max(at_once, key=lambda r: (r[1] is not None, r[1]))


def test_spells_of_a_stream_equal_those_by_hand(spark, tmp_path):
    """Window by window in the JVM: a trace does not cross to Python to keep its state."""
    records = restless(8, 60)
    folder = in_batches(spark, random.Random(1).sample(records, len(records)), tmp_path / "raw", 1)
    stream = spells.stuck_spells(produced(replays._signals(spark, folder, wire.WATERMARK_DELAY, None)))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "session_window" in plan
    expected = []
    for r in signals(files.read_raw(spark, f"{folder}/records")).collect():
        expected.append((r["trace_id"], (int(r["event_time"].timestamp() * 1000 + 0.5), r["hop_count"])))
    by_trace = {}
    for trace, last in expected:
        by_trace[trace] = spells.joined(by_trace.get(trace, []), last, 60_000)
    ended = sorted((trace, *last) for trace, held in by_trace.items() for _, last in held)
    found = replays._worked_off(stream, "out", str(tmp_path / "out"))
    columns = ["trace_id", "last_seen_ts_ms", "last_hop_count"]
    assert sorted(tuple(r) for r in found.select(columns).collect()) == ended and len(ended) > 60


def services(minutes):
    """Records of services by the minutes they are active in."""
    return [
        record(START + m * MINUTE + 1000 * i, service=name, trace=f"{m:032x}")
        for name, active in minutes.items() for m in active for i in range(3)
    ]


ACTIVE = {"steady": range(0, 300), "stops": [*range(0, 20), *range(23, 40)], "returns": [0, 1, 130, 131, 250]}


@pytest.mark.parametrize("batches", [1, 4])
def test_a_service_that_stops_is_told(spark, tmp_path, batches):
    folder = in_batches(spark, services(ACTIVE), tmp_path / "raw", batches)
    found = run(spark, folder, lambda s: liveness.silent_services(produced(s)), tmp_path / "out", batches)
    minutes = {}
    for r in found.collect():
        minutes.setdefault(r["this_service"], []).append((r["window_start"] - START) // MINUTE)
    # Two silent minutes make a window; an hour after the last record it is forgotten.
    assert {k: sorted(v) for k, v in minutes.items()} == {
        "steady": list(range(300, 359)),
        "stops": [20, 21, *range(40, 99)],
        "returns": [*range(2, 61), *range(132, 191), *range(251, 310)],
    }
    batch = meters.silent_services(produced(signals(files.read_raw(spark, f"{folder}/records"))))
    never = run(spark, folder, lambda s: liveness.silent_services(produced(s), forget_ms=10**12), tmp_path / "never", 1)
    ended = never.where(F.col("window_start") <= START + 298 * MINUTE)
    same(ended, batch)


@pytest.mark.parametrize("batches", [1, 4])
def test_new_services(spark, tmp_path, batches):
    folder = in_batches(spark, services(ACTIVE), tmp_path / "raw", batches)
    batch = produced(signals(files.read_raw(spark, f"{folder}/records")))
    found = run(spark, folder, lambda s: liveness.new_services(produced(s)), tmp_path / "out", batches)
    same(found.drop("first"), meters.new_services(batch))
    first = found.where("first").select("this_service", F.col("window_start").alias("first_window_start"))
    same(first, questions.first_appearance(batch))
    soon = run(spark, folder, lambda s: liveness.new_services(produced(s), forget_ms=7_200_000), tmp_path / "soon", batches)
    again = soon.where("first and this_service = 'returns'").select("window_start").collect()
    assert sorted((r[0] - START) // MINUTE for r in again) == [0, 130]
    with pytest.raises(ValueError):
        liveness.new_services(batch, forget_ms=1)


def test_state_ends(spark, tmp_path):
    """Every kind of state is empty once the last of its timers or bounds has passed."""
    folder = in_batches(spark, services(ACTIVE) + restless(4, 8), tmp_path / "raw", 3)
    stream = replays._signals(spark, folder, wire.WATERMARK_DELAY, None)
    hours = 7_200_000
    for name, build in {
        "silent": liveness.silent_services(produced(stream)),
        "new": liveness.new_services(produced(stream), forget_ms=hours),
        "spells": spells.stuck_spells(produced(stream)),
        "completions": fates.completions(stream),
    }.items():
        query = (
            build.writeStream.outputMode("append").format("noop").queryName(name)
            .option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        rows = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]
        assert max(rows) > 0 and rows[-1] == 0, (name, rows)


def chain(seed, traces=40):
    """Traces that complete, stop, come late or come twice, with markers."""
    rng, out = random.Random(seed), []
    for i in range(traces):
        at, trace, fate = START + rng.randint(0, 20_000_000), f"{i:032x}", rng.random()
        stages = 3 if fate > 0.4 else 1 + (fate > 0.2)
        for hop, (topic, service) in enumerate(list(zip(wire.STAGE_TOPICS, wire.CHAIN))[:stages], 1):
            pipeline = "orders" if i % 3 else None
            common = dict(trace=trace, topic=topic, service=service, hop=hop, pipeline=pipeline)
            for _ in range(1 + (rng.random() < 0.1)):
                out.append(record(at, **common))
            if rng.random() < 0.9:
                out.append(record(at + 100, consumer=wire.CHAIN[hop], **common))
            at += rng.choice([500, 4000, 59_999, 90_000])
    return out


@pytest.mark.parametrize("batches", [1, 3])
def test_fates_equal_batch(spark, tmp_path, batches):
    folder = in_batches(spark, chain(6), tmp_path / "raw", batches)
    rows = signals(files.read_raw(spark, f"{folder}/records"))
    finished = replays.finished_fates(folder, str(tmp_path / "out"), spark, 1 if batches > 1 else None)
    completed = spark.read.parquet(f"{tmp_path}/out/completions")
    same(fates.completion_share(completed), questions.completion(rows))
    same(fates.audit(finished), questions.audit(rows))
    matched = run(spark, folder, fates.drop_off, tmp_path / "drop", batches)
    found = fates.drop_off_per_minute(matched).where("not consumed").agg(F.sum("traces"), F.sum("dropped")).first()
    between = questions.lost_between(produced(rows), (wire.ENRICHED, wire.FULFILLED)).first()
    assert tuple(found) == (between["traces"], between["lost"]) and found[1] > 0


def test_replays_look_up_the_headers_they_need(spark, tmp_path):
    """The join of placed and taken records and the alerts of the audit read different
    headers; none reads them all, and no state counts its rows twice over."""
    folder = in_batches(spark, chain(9), tmp_path / "raw", 1)
    for fields, unused in ((replays._PLACED, wire.HOP_COUNT), (replays._ALERTED, wire.ORIGIN_TS)):
        plan = replays._signals(spark, folder, wire.WATERMARK_DELAY, None, fields)._jdf.queryExecution().toString()
        assert f"'{unused}'" not in plan and f" {unused})" not in plan and f"{unused} " not in plan
        assert wire.TRACE_ID in plan
    before = spark.conf.get(replays._COUNTED, None)
    rows = signals(files.read_raw(spark, f"{folder}/records"))
    same(fates.audit(replays.finished_fates(folder, str(tmp_path / "out"), spark)), questions.audit(rows))
    assert spark.conf.get(replays._COUNTED, "true") == (before or "true")


def test_what_comes_after_the_horizon_does_not_count(spark, tmp_path):
    common = dict(topic=wire.FULFILLED, service=wire.FULFILLMENT, hop=3, consumer=wire.SHIPPING)
    rows = [record(START + i, trace=f"{i:032x}") for i in range(2)]
    rows += [record(START + 3_600_000, trace=f"{0:032x}", **common), record(START + 3_600_002, trace=f"{1:032x}", **common)]
    folder = in_batches(spark, rows, tmp_path / "raw", 1)
    found = run(spark, folder, fates.completions, tmp_path / "out", 1).collect()
    assert {r["trace_id"][-1]: r["done_time"] is not None for r in found} == {"0": True, "1": False}


def untagged(ms):
    return record(ms, trace=None)


REPLAYS = {
    "silent": (lambda s: liveness.silent_services(produced(s)), {"this_service"}, False),
    "sightings": (lambda s: liveness.new_services(produced(s)), {"this_service"}, False),
    "stuck": (lambda s: spells.stuck_spells(produced(s)), set(replays._ALERTED), True),
    "drop_off": (fates.drop_off, {"this_topic"}, True),
    "completion": (fates.completions, set(replays._PLACED), True),
}


@pytest.mark.parametrize("name", REPLAYS)
def test_a_replay_stores_what_its_stream_needs(spark, tmp_path, monkeypatch, name):
    """No payload, no list of headers, no header that is not asked for, and ids only if
    the stream goes by them; the rows are those of a stream over whole records, with
    untagged records, markers and records without a time among them."""
    build, needed, by_trace = REPLAYS[name]
    records = services(ACTIVE) + chain(12) + [untagged(START - 5), untagged(START + 40_000_000)]
    whole = frame(spark, records).unionByName(
        frame(spark, [record(START, trace="f" * 32)]).withColumn("event_time", F.lit(None).cast("timestamp"))
    )
    monkeypatch.setattr(replays, "scratch_path", lambda spark, kind: str(tmp_path / kind))
    found = getattr(replays, name)(whole)
    kept = spark.read.parquet(str(tmp_path / "replay" / "records"))
    assert set(kept.columns) == {"event_time", "trace_id", "consumer_service"} | needed
    assert kept.count() == len(records) + 1 and kept.where("trace_id is null").count() == 2
    assert (kept.select("trace_id").distinct().count() > 2) == by_trace
    expected = run(spark, in_batches(spark, records, tmp_path / "raw", 1), build, tmp_path / "whole", 1)
    finish = {"drop_off": fates.drop_off_per_minute, "completion": fates.completion_share}.get(name, lambda df: df)
    same(found, finish(expected))


def test_the_audit_stores_its_headers_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replays, "scratch_path", lambda spark, kind: str(tmp_path / kind))
    rows = frame(spark, chain(13))
    found = replays.audit(rows)
    kept = spark.read.parquet(str(tmp_path / "replay" / "records"))
    assert set(kept.columns) == {"event_time", "trace_id", "consumer_service", *replays._PLACED, *replays._ALERTED}
    same(found, questions.audit(signals(rows)))


def test_untagged_records_move_the_watermark_of_stored_columns(spark, tmp_path):
    """Service ``a`` comes once; only the untagged closing record tells that it is silent."""
    folder = replays.stored(frame(spark, [record(START, service="a")]), ["this_service"], False)
    closing = files.read_texts(spark, f"{folder}/closing").first()
    assert closing["trace_id"] is None and closing["this_service"] is None
    stream = replays._stored_signals(spark, folder, wire.WATERMARK_DELAY, None, ["this_service"])
    found = replays._worked_off(liveness.silent_services(produced(stream)), "out", str(tmp_path / "out"))
    assert sorted((r["window_start"] - START) // MINUTE for r in found.collect()) == list(range(1, 60))
