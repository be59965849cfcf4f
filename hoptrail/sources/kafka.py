"""Raw records from Kafka topics, and reports back to them.

The Kafka connector is a package of its own that a cluster adds with
``--packages``; without it these functions say so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail import schemas, wire


def kafka_available(spark: SparkSession) -> bool:
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception:
        return False
    return True


def _require(spark: SparkSession) -> None:
    if not kafka_available(spark):
        raise RuntimeError("the Kafka connector is not on the classpath; add spark-sql-kafka-0-10")


def source_options(
    servers: str,
    topics: Sequence[str] = wire.SOURCE_TOPICS,
    starting: str = "earliest",
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a read. ``min_partitions`` lets Spark cut a busy topic
    partition into several tasks; ``extra`` takes security settings or a bound
    on offsets per micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "includeHeaders": "true",
        **(extra or {}),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def as_raw(records: DataFrame) -> DataFrame:
    """Columns of the Kafka source under the names of the raw schema. The value
    stays bytes: no report looks into it."""
    return records.select(
        "value",
        F.col("headers").cast(schemas.HEADERS).alias("headers"),
        F.col("timestamp").alias("event_time"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "key",
    )


def read_raw(spark: SparkSession, servers: str, stream: bool = True, **options) -> DataFrame:
    _require(spark)
    reader = spark.readStream if stream else spark.read
    return as_raw(reader.format("kafka").options(**source_options(servers, **options)).load())


def report_records(report: DataFrame, name: str) -> DataFrame:
    """A report as Kafka records: one JSON value per row, for its own topic."""
    return report.select(
        F.lit(wire.REPORT_TOPICS[name]).alias("topic"), F.to_json(F.struct("*")).alias("value")
    )


def stage_records(raw: DataFrame) -> DataFrame:
    """Records a stage sends, as columns of the Kafka sink, headers included."""
    return raw.select(F.col("kafka_topic").alias("topic"), "key", "value", "headers")
