from __future__ import annotations

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hoptrail import schemas, session, wire
from hoptrail.operators import views
from hoptrail.sources import events, files, kafka
from tests.records import START, frame, golden_chain, headers


def test_kafka_options():
    options = kafka.source_options("host:9092", starting="latest", min_partitions=64, extra={"maxOffsetsPerTrigger": "9"})
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": ",".join(wire.SOURCE_TOPICS),
        "startingOffsets": "latest",
        "includeHeaders": "true",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "9",
    }


def test_kafka_columns_become_raw(spark):
    records = spark.createDataFrame(
        [(None, b"v", "t", 3, 9, dt.datetime(2024, 1, 1), 0, headers(trace_id="a", pipeline="p"))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp,"
        "timestampType int, headers array<struct<key:string,value:binary>>",
    )
    raw = kafka.as_raw(records)
    schemas.conform(raw, schemas.RAW)
    assert views.produce_view(raw).first().pipeline == "p"


def test_missing_connector_is_named(spark):
    if kafka.kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka.read_raw(spark, "host:9092")


def test_report_records_go_to_their_topic(spark):
    report = spark.createDataFrame([], schemas.REPORTS["coverage_report_1m"]).unionByName(
        spark.createDataFrame([(1, 2, "p", "t", "o", 3, 4)], schemas.REPORTS["coverage_report_1m"])
    )
    row = kafka.report_records(report, "coverage_report_1m").first()
    assert row.topic == wire.REPORT_TOPICS["coverage_report_1m"]
    assert row.value == (
        '{"window_start":1,"window_end":2,"pipeline":"p","this_topic":"t","origin_service":"o",'
        '"distinct_traces":3,"records":4}'
    )


def test_stage_records_carry_their_headers(spark):
    raw = frame(spark, golden_chain()[:1])
    row = kafka.stage_records(raw).first()
    assert (row.topic, row.key, row.value) == (wire.PLACED, b"key", b"payload")
    assert len(row.headers) == 7
    assert kafka.stage_records(raw.withColumn("key", F.lit(b"k"))).first().key == b"k"


def test_raw_round_trip(spark, tmp_path):
    raw = frame(spark, golden_chain())
    raw.write.parquet(f"{tmp_path}/raw")
    back = files.read_raw(spark, f"{tmp_path}/raw")
    schemas.conform(back, schemas.RAW)
    assert views.produce_view(back).count() == views.consume_view(back).count() == 3


def test_landed_schema(spark, tmp_path):
    files.land(frame(spark, golden_chain()), f"{tmp_path}/landed")
    back = files.read_landed(spark, f"{tmp_path}/landed")
    schemas.conform(back, files.LANDED)
    assert back.count() == 6
    assert back.select("event_date").distinct().collect()[0][0] == dt.date(2024, 1, 1)
    assert files.landed_days(back, "2024-01-02", "2024-01-03").count() == 0


def test_fan_in_keeps_every_topic(spark):
    raw = frame(spark, golden_chain())
    topics = [raw.where(F.col("kafka_topic") == t) for t in wire.SOURCE_TOPICS]
    assert views.fan_in(*topics).count() == raw.count()


def test_derived_records_match_the_raw_schema(spark, small):
    raw = events.raw_records(spark, small).select(*schemas.RAW.names)
    schemas.conform(raw, schemas.RAW)
    assert raw.where(F.col("event_time") < F.timestamp_millis(F.lit(START - 86_400_000))).count() == 0


def test_records_are_derived_by_many_tasks_and_trails_written_once(spark, small):
    one = events.read_events(spark, small).rdd.getNumPartitions()
    raw = events.raw_records(spark, small, with_trail=True)
    assert raw.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > one
    plan = raw.select("headers")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJson") == 1


class ClusterSession:
    """The two things a session tells about its cluster."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(ClusterSession("yarn", "/shared/place")) == "/shared/place"
    assert session.shared_folder(ClusterSession("local[8]", "/shared/place")) == "/shared/place"


def test_only_a_local_session_may_do_without():
    folder = session.shared_folder(ClusterSession("local[8]", None))
    assert folder and session.shared_folder(ClusterSession("local[8]", None)) == folder
    with pytest.raises(ValueError):
        session.shared_folder(ClusterSession("yarn", None))


def test_one_trace_reads_its_days_and_few_rows(spark, small, tmp_path):
    raw = events.raw_records(spark, small)
    for i in range(3):  # as streams leave them: several files per day
        files.land(raw.where(F.col("kafka_offset") % 3 == i), f"{tmp_path}/landed", "append", tasks_per_day=4)
    landed = files.read_landed(spark, f"{tmp_path}/landed")
    table = files.compact(landed, f"{tmp_path}/compacted", "1970-01-01", "9999-12-31", tasks_per_day=2)
    assert table.exceptAll(landed).count() == 0 and table.count() == landed.count()
    days = [d for d in os.listdir(f"{tmp_path}/compacted") if d.startswith("event_date=")]
    assert len(days) == 3
    for day in days:
        written = [f for f in os.listdir(f"{tmp_path}/compacted/{day}") if f.endswith(".parquet")]
        assert 1 <= len(written) <= 2
        for name in written:
            ids = pq.read_table(f"{tmp_path}/compacted/{day}/{name}", columns=["trace_id"]).column(0).to_pylist()
            assert ids == sorted(ids)
    one = table.where("event_date = '2024-01-01'").agg(F.max("trace_id")).first()[0]
    found = files.trace_records(table, one, days=0)
    assert found.exceptAll(landed.where(F.col("trace_id") == one)).count() == 0 and found.count() > 0
    scan = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x][0]
    assert "event_date" in scan.split("PartitionFilters")[1].split("]")[0] and f"EqualTo(trace_id,{one})" in scan
    # A day is replaced as a whole, the others stay.
    files.compact(landed.where("event_date = '2024-01-01'"), f"{tmp_path}/compacted", "2024-01-01", "2024-01-01")
    assert files.read_landed(spark, f"{tmp_path}/compacted").count() == landed.count()
    for odd in ("nonsense", "f" * 32, ""):
        assert files.trace_records(table, odd).count() == 0
