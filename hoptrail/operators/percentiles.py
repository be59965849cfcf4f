"""Latency percentiles: exact, by rank sketch, or from stored sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.windows import tumble, window_bounds
from hoptrail.wire import QUANTILES, WINDOW_MS

DIMS = ["pipeline", "origin_service", "this_topic"]

# Rank error of percentile_approx is 1/accuracy; a hundred buckets would not
# tell the 99th percentile from the maximum.
ACCURACY = 10_000
KLL_K = 400
# Rank errors to expect: by definition, and for that k with 99 % confidence.
APPROX_ERROR = 1 / ACCURACY
KLL_ERROR = 0.01


def _name(quantile: float) -> str:
    return f"p{round(quantile * 100):d}_ms"


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of the keys of two aliased frames, null keys included."""
    matches = [F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in keys]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    return condition


# Bits of a value that each narrowing step leaves open. A step orders at most
# 2**22 buckets of a key, and the last one at most 2**21 values.
NARROWING = (42, 21)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Interpolated percentiles of an integer column per key, without gathering
    a group anywhere.

    Rows collapse to counts per distinct value first. Counts per bucket then
    tell which bucket holds each wanted rank, and only the values inside those
    buckets go on, to buckets a fraction as wide and at last to single values.
    Buckets are cut by the bits of the value, so a step never orders more than
    some millions of possible buckets or values, wherever the values lie and
    however many rows a key has.
    """
    held = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at = {q: (F.col("total") - 1) * F.lit(q) for q in quantiles}
    wanted = F.lit(False)
    for q in quantiles:
        for edge in (F.floor, F.ceil):
            wanted = wanted | ((edge(at[q]) >= F.col("before")) & (edge(at[q]) < F.col("through")))
    wide: list[str] = []
    for bits in NARROWING:
        held = held.withColumn("bucket", F.shiftright("value", bits))
        in_order = Window.partitionBy(*keys, *wide).orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        if wide:
            counts = held.groupBy(*keys, *wide, "bucket").agg(
                F.sum("n").alias("bucket_n"), F.first("before").alias("start"), F.first("total").alias("total")
            )
        else:
            counts = held.groupBy(*keys, "bucket").agg(F.sum("n").alias("bucket_n")).withColumns(
                {"start": F.lit(0).cast("bigint"), "total": F.sum("bucket_n").over(Window.partitionBy(*keys))}
            )
        chosen = (
            counts.withColumn("through", F.col("start") + F.sum("bucket_n").over(in_order))
            .withColumn("before", F.col("through") - F.col("bucket_n"))
            .where(wanted)
            .select(*keys, "bucket", "before", "total")
        )
        held = (
            held.select(*keys, "value", "n", "bucket")
            .alias("all")
            .join(chosen.alias("chosen"), _same("all", "chosen", [*keys, "bucket"]))
            .select(*[F.col(f"all.{k}").alias(k) for k in keys], "value", "n", "before", "total",
                    F.col("all.bucket").alias("wide"))
        )
        wide = ["wide"]
    in_bucket = (
        Window.partitionBy(*keys, "wide")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = held.withColumn("upto", F.col("before") + F.sum("n").over(in_bucket))

    def value_at(rank: Column) -> Column:
        here = (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto"))
        return F.max(F.when(here, F.col("value")))

    picked = placed.groupBy(*keys).agg(
        F.first("total").alias("total"),
        *[value_at(F.floor(at[q])).alias(f"low_{i}") for i, q in enumerate(quantiles)],
        *[value_at(F.ceil(at[q])).alias(f"high_{i}") for i, q in enumerate(quantiles)],
    )

    def between(i: int, q: float) -> Column:
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        share = at[q] - F.floor(at[q])
        return low * (1 - share) + high * share

    return picked.select(
        *keys,
        *[between(i, q).cast("double").alias(_name(q)) for i, q in enumerate(quantiles)],
        F.col("total").alias("sample_count"),
    )


def latency_percentiles(
    produce: DataFrame,
    method: str = "exact",
    quantiles: Sequence[float] = QUANTILES,
    size_ms: int = WINDOW_MS,
) -> DataFrame:
    """Latency percentiles per minute, pipeline, origin and topic.

    ``exact`` is for static frames, ``approx`` and ``kll`` also stream: they
    keep a bounded summary per key however many records arrive.
    """
    windowed, key = tumble(produce.where(F.col("latency_ms").isNotNull()), size_ms)
    if method == "exact":
        if produce.isStreaming:
            raise ValueError("exact percentiles need a static frame; stream with approx or kll")
        result = exact_percentiles(windowed, [*key, *DIMS], "latency_ms", quantiles)
        points = [F.col(_name(q)) for q in quantiles]
    elif method == "approx":
        result = windowed.groupBy(*key, *DIMS).agg(
            F.percentile_approx("latency_ms", list(quantiles), ACCURACY).alias("points"),
            F.count(F.lit(1)).alias("sample_count"),
        )
        points = [F.col("points")[i].cast("double").alias(_name(q)) for i, q in enumerate(quantiles)]
    elif method == "kll":
        result = latency_sketches(produce, size_ms)
        points = sketch_quantiles(quantiles)
    else:
        raise ValueError(f"unknown percentile method {method!r}")
    return result.select(*window_bounds(result, size_ms), *DIMS, *points, "sample_count")


def latency_sketches(produce: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """A mergeable latency sketch per minute and dimensions, a few KB each."""
    windowed, key = tumble(produce.where(F.col("latency_ms").isNotNull()), size_ms)
    return windowed.groupBy(*key, *DIMS).agg(
        F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), KLL_K).alias("sketch"),
        F.count(F.lit(1)).alias("sample_count"),
    )


def sketch_quantiles(quantiles: Sequence[float] = QUANTILES) -> list[Column]:
    return [
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(_name(q)) for q in quantiles
    ]


def merge_sketches(sketches: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Roll stored sketches up to coarser keys without going back to the records."""
    merged = sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"), F.sum("sample_count").alias("sample_count")
    )
    return merged.select(*keys, *sketch_quantiles(quantiles), "sample_count")


def within_rank_error(
    df: DataFrame,
    found: DataFrame,
    keys: Sequence[str],
    value: str,
    error: float,
    quantiles: Sequence[float] = QUANTILES,
) -> DataFrame:
    """Per key, whether each quantile of ``found`` has a rank in ``df`` that is off
    by at most ``error`` times the number of rows (and one row)."""
    names = [_name(q) for q in quantiles]
    held = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"))
    beside = held.alias("all").join(found.select(*keys, *names).alias("found"), _same("all", "found", keys))
    total = F.count(F.lit(1))

    def near(name: str, q: float) -> Column:
        below, through = F.count_if(F.col("value") < F.col(name)), F.count_if(F.col("value") <= F.col(name))
        slack = total * F.lit(error) + 1
        return ((below - slack <= total * F.lit(q)) & (through + slack >= total * F.lit(q))).alias(
            name.replace("_ms", "_near")
        )

    return beside.groupBy(*[F.col(f"all.{key}").alias(key) for key in keys]).agg(
        total.alias("sample_count"), *[near(name, q) for name, q in zip(names, quantiles)]
    )
