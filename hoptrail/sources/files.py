"""Raw and decoded records in Parquet folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from hoptrail import schemas, wire
from hoptrail.operators.trails import RECORD
from hoptrail.operators.views import signals
from hoptrail.streaming import sinks

_RAW_TYPES = {field.name: field for field in schemas.RAW}
_SIGNAL_TYPES = {f.name: f for f in schemas.PRODUCE} | {f.name: f for f in schemas.CONSUME}

# Decoded records as they are landed, partitioned by day.
LANDED = StructType(
    [
        _SIGNAL_TYPES[name]
        for name in (
            "trace_id",
            "origin_ts_ms",
            "origin_service",
            "pipeline",
            "this_service",
            "this_topic",
            "hop_count",
            "consumer_service",
            "event_time",
        )
    ]
    + [_RAW_TYPES[name] for name in RECORD]
    + [StructField("event_date", DateType())]
)


def read_raw(
    spark: SparkSession, folder: str, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Raw records from Parquet files, as a table or as a stream of new files."""
    return _read(spark, schemas.RAW, folder, stream, files_per_trigger)


def read_texts(
    spark: SparkSession, folder: str, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """Stored text columns of records; those that were not stored are null."""
    return _read(spark, schemas.TEXTS, folder, stream, files_per_trigger)


def _read(
    spark: SparkSession, schema: StructType, folder: str, stream: bool, files_per_trigger: int | None
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(schema).option("recursiveFileLookup", "true")
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def landed_columns(raw: DataFrame) -> DataFrame:
    """Decoded records with the day they belong to; the payload stays behind."""
    return signals(raw, RECORD).withColumn("event_date", F.to_date("event_time"))


def land(raw: DataFrame, folder: str, mode: str = "overwrite", tasks_per_day: int = 64) -> None:
    """Decode once and keep the narrow columns, so that later reads need neither
    headers nor payload and skip the days they do not ask for. A day is dealt to
    ``tasks_per_day`` tasks by its offsets, so it becomes so many files and a busy day
    is no single task."""
    part = F.pmod(F.xxhash64(*RECORD), F.lit(tasks_per_day))
    dealt = landed_columns(raw).repartition("event_date", part)
    dealt.write.mode(mode).partitionBy("event_date").parquet(folder)


# What makes a file of landed records quick to search for one trace: records lie in
# order of their trace, so most row groups are ruled out by their bounds, and a Bloom
# filter per row group rules out the rest.
LOOKUP = {
    "parquet.bloom.filter.enabled#trace_id": "true",
    "parquet.bloom.filter.expected.ndv#trace_id": "500000",
    "parquet.block.size": str(16 << 20),
}


def compact(
    landed: DataFrame, folder: str, first: str, last: str, tasks_per_day: int = 16
) -> DataFrame:
    """Rewrite the given landed days, however many small files a stream left of them,
    into ``tasks_per_day`` files each, clustered by trace; gives the compacted table.
    Days already there are replaced as a whole, others are left alone."""
    days = landed_days(landed, first, last)
    part = F.pmod(F.xxhash64("trace_id"), F.lit(tasks_per_day))
    (
        days.repartition("event_date", part)
        .sortWithinPartitions("event_date", "trace_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**LOOKUP)
        .partitionBy("event_date")
        .parquet(folder)
    )
    return read_landed(landed.sparkSession, folder)


def trace_records(landed: DataFrame, trace_id: str, days: int = 1) -> DataFrame:
    """The landed records of one trace. Its id tells the moment it began, so only that
    day and ``days`` more are looked at, and the day before for clocks that are behind.
    An id that tells no time is looked for on all days."""
    own = landed.where(F.col("trace_id") == trace_id)
    try:
        began = dt.datetime.fromtimestamp(int(trace_id[:12], 16) / 1000, dt.timezone.utc).date()
        first, last = began - dt.timedelta(days=1), began + dt.timedelta(days=days)
    except (ValueError, OverflowError):
        return own
    return own.where(F.col("event_date").between(F.lit(first), F.lit(last)))


def start_landing(
    raw: DataFrame, folder: str, checkpoint: str, every: str | None = wire.CHECKPOINT_EVERY
) -> StreamingQuery:
    """The same for a stream: decode each record once for all reports."""
    return sinks.start_append(landed_columns(raw), "landing", folder, checkpoint, every, ("event_date",))


def read_landed(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(LANDED).parquet(folder)


def landed_days(landed: DataFrame, first: str, last: str) -> DataFrame:
    """The days asked for; prunes whole partitions of the landed table."""
    return landed.where(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
