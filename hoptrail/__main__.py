"""``python -m hoptrail``: run the jobs, for spark-submit and by hand."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.operators.views import signals
from hoptrail.plans import jobs
from hoptrail.session import apply_settings
from hoptrail.sources import files, kafka
from hoptrail.streaming import stages
from hoptrail.streaming.watermarks import watermark_each, with_watermark


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="hoptrail", description="Reports over trace headers")
    out.add_argument(
        "mode",
        choices=["batch", "stream", "watch", "stage", "annotate"],
        help="reports of stored records; the same as streams; silent and new services, completions and stuck"
        " traces as streams; a service that sends records on; causes of the alerts in --out",
    )
    source = out.add_mutually_exclusive_group()
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--raw", help="folder of raw records in Parquet")
    out.add_argument("--out", required=True, help="folder the tables go to, with the checkpoints beside them")
    out.add_argument("--to-kafka", help="bootstrap servers that reports and sent records go to instead")
    out.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    out.add_argument("--checkpoints", help="folder of the streams' checkpoints; by default beside the tables")
    out.add_argument("--delay", default=wire.WATERMARK_DELAY, help="how late a record may be in a stream")
    out.add_argument("--watermark-each", action="store_true", help="a watermark per topic; the slowest one decides")
    out.add_argument("--direct", action="store_true", help="stream every report from the source, without landing")
    out.add_argument("--percentiles", choices=["exact", "approx", "kll"])
    out.add_argument("--once", action="store_true", help="work off what is there and stop")
    out.add_argument("--service", help="stage: the service that consumes")
    out.add_argument("--topic", help="stage: the topic it consumes")
    out.add_argument("--out-topic", help="stage: the topic it sends to; without one it only leaves markers")
    out.add_argument("--model", help="annotate: module:function that opens the model")
    return out


def _topic(spark: SparkSession, args: argparse.Namespace, topics: Sequence[str]) -> DataFrame:
    stream = args.mode != "batch"
    if args.kafka:
        return kafka.read_raw(spark, args.kafka, stream, topics=topics, starting=args.starting)
    if args.raw:
        return files.read_raw(spark, args.raw, stream).where(F.col("kafka_topic").isin(*topics))
    raise SystemExit("name a source with --kafka or --raw")


def watermarked(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The source topics with one watermark over all or one for each."""
    if args.watermark_each:
        return watermark_each(*[_topic(spark, args, [t]) for t in wire.SOURCE_TOPICS], delay=args.delay)
    return with_watermark(_topic(spark, args, wire.SOURCE_TOPICS), args.delay)


def start(spark: SparkSession, args: argparse.Namespace) -> list:
    """Start what the arguments ask for; gives the streams."""
    every = None if args.once else wire.CHECKPOINT_EVERY
    checkpoints = args.checkpoints or f"{args.out}/_checkpoints"
    if args.mode == "batch":
        raw = _topic(spark, args, wire.SOURCE_TOPICS)
        jobs.run_batch(spark, raw, args.out, percentile_method=args.percentiles or "exact")
        return []
    if args.mode == "annotate":
        module, _, name = (args.model or "").partition(":")
        if not name:
            raise SystemExit("name the model with --model module:function")
        return jobs.start_patient_annotation(spark, args.out, getattr(importlib.import_module(module), name), every)
    if args.mode == "stage":
        if not (args.service and args.topic):
            raise SystemExit("name --service and --topic")
        raw, checkpoint = _topic(spark, args, [args.topic]), f"{checkpoints}/stage-{args.service}"
        if args.to_kafka:
            return [stages.run_stage_to_kafka(raw, args.service, args.out_topic, args.to_kafka, checkpoint, every=every)]
        return [stages.run_stage(raw, args.service, args.out_topic, args.out, checkpoint, every=every)]
    if args.mode == "watch":
        return jobs.start_watch_streams(signals(watermarked(spark, args)), args.out, args.checkpoints, every)
    method = args.percentiles or "kll"
    if args.to_kafka:
        return jobs.start_kafka_reports(signals(watermarked(spark, args)), args.to_kafka, checkpoints, method, every)
    if args.direct or args.watermark_each:
        rows = signals(watermarked(spark, args))
        return jobs.start_report_streams(rows, args.out, args.checkpoints, method, every)
    raw = _topic(spark, args, wire.SOURCE_TOPICS)
    return jobs.start_landed_streams(raw, args.out, args.checkpoints, args.delay, every, method)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = apply_settings(SparkSession.builder.appName("hoptrail").getOrCreate())
    queries = start(spark, args)
    if args.once:
        for query in queries:
            query.awaitTermination()
    elif queries:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
