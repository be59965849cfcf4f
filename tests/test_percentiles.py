from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.operators import percentiles
from tests.records import START


@pytest.fixture(scope="module")
def uniform(spark):
    """Latencies 0 to 999 within one minute."""
    return spark.range(1000).select(
        F.lit("orders").alias("pipeline"),
        F.lit(wire.INTAKE).alias("origin_service"),
        F.lit(wire.PLACED).alias("this_topic"),
        F.timestamp_millis(F.lit(START) + F.col("id") * 7).alias("event_time"),
        F.col("id").alias("latency_ms"),
    )


@pytest.mark.parametrize("method", ["exact", "approx", "kll"])
def test_uniform(uniform, method):
    row = percentiles.latency_percentiles(uniform, method).first()
    assert row.sample_count == 1000
    assert abs(row.p50_ms - 500) < 20 and abs(row.p95_ms - 950) < 20 and abs(row.p99_ms - 990) < 20


def test_merged_sketches_agree_with_one_over_all(uniform):
    parts = percentiles.latency_sketches(uniform, size_ms=1000)
    assert parts.count() == 7
    row = percentiles.merge_sketches(parts, ["pipeline"]).first()
    assert row.sample_count == 1000
    assert abs(row.p50_ms - 500) < 20 and abs(row.p95_ms - 950) < 20 and abs(row.p99_ms - 990) < 20


def test_stored_sketches_survive(uniform, tmp_path, spark):
    percentiles.latency_sketches(uniform).write.parquet(f"{tmp_path}/sketches")
    direct = percentiles.latency_percentiles(uniform, "kll").first()
    stored = percentiles.merge_sketches(spark.read.parquet(f"{tmp_path}/sketches"), ["pipeline"]).first()
    assert abs(stored.p99_ms - direct.p99_ms) < 20


@pytest.mark.parametrize("method", ["exact", "approx", "kll"])
def test_no_latency_no_row(uniform, method):
    nothing = uniform.withColumn("latency_ms", F.lit(None).cast("bigint"))
    assert percentiles.latency_percentiles(nothing, method).count() == 0


def test_unknown_method(uniform):
    with pytest.raises(ValueError):
        percentiles.latency_percentiles(uniform, "guess")
