"""Where reports go, and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hoptrail import schemas, wire
from hoptrail.sources.kafka import report_records


def checkpoint_folder(folder: str, name: str) -> str:
    """A query's checkpoint lies beside its output, so a restart finds it and two
    jobs with outputs of their own never share one."""
    return f"{folder}/_checkpoints/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def guarded_checkpoint(spark: SparkSession, table: str, checkpoint: str) -> str:
    """The checkpoint, unless it is new while the table was streamed to before.

    The table's own log knows the numbers of the batches it has; a new checkpoint
    starts from number 0 again, and the table would skip those batches silently."""
    if _exists(spark, f"{table}/_spark_metadata") and not _exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{table} belongs to another checkpoint than {checkpoint}; its batches would be skipped")
    return checkpoint


def start_append(
    df: DataFrame, name: str, table: str, checkpoint: str, every: str | None, partitions: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append a stream to a Parquet table, each row once. Without ``every``, work off
    what is there and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", guarded_checkpoint(df.sparkSession, table, checkpoint))
        .trigger(**trigger)
        .format("parquet")
    )
    return (writer.partitionBy(*partitions) if partitions else writer).start(table)


def start_report(
    report: DataFrame,
    name: str,
    folder: str,
    checkpoint: str | None = None,
    every: str | None = wire.CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Append a streaming report to its Parquet table, each row once. Without
    ``every``, work off what is there and stop."""
    schemas.conform(report, schemas.REPORTS[name])
    return start_append(report, name, f"{folder}/{name}", checkpoint or checkpoint_folder(folder, name), every)


# Named here so that a test can put another sink in its place.
KAFKA = "kafka"


def start_records(
    records: DataFrame, name: str, servers: str, checkpoint: str, every: str | None = wire.CHECKPOINT_EVERY
) -> StreamingQuery:
    """Send a stream of records (``topic``, ``value`` and, if there, ``key`` and
    ``headers``) to Kafka, each at least once."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        records.writeStream.queryName(name)
        .outputMode("append")
        .format(KAFKA)
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", str("headers" in records.columns).lower())
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_report_to_kafka(
    report: DataFrame,
    name: str,
    servers: str,
    checkpoint: str,
    every: str | None = wire.CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Append a streaming report to its topic, each row at least once."""
    schemas.conform(report, schemas.REPORTS[name])
    return start_records(report_records(report, name), name, servers, checkpoint, every)


def write_report(report: DataFrame, name: str, folder: str) -> None:
    """Write a batch report, replacing an earlier run of it."""
    schemas.conform(report, schemas.REPORTS[name]).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_report(spark: SparkSession, folder: str, name: str, stream: bool = False) -> DataFrame:
    """A report table, from its first row on."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schemas.REPORTS[name]).parquet(f"{folder}/{name}")


def register_reports(spark: SparkSession, folder: str, *names: str) -> None:
    """Make report tables available to ad-hoc SQL under their own names."""
    for name in names:
        read_report(spark, folder, name).createOrReplaceTempView(name)
