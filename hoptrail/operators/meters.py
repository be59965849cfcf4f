"""Metric queries over the decoded records, as windowed aggregations.

Counts are exact per event-time window. Queries over five minutes slide by one
minute: records are first summed per minute, and only those few rows are copied
into the windows they belong to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail import wire
from hoptrail.functions.windows import slide, tumble, window_bounds
from hoptrail.operators.views import with_latency

FIVE_MINUTES = 300_000
HOUR = 3_600_000
TINY = 1e-9


def _seconds(total: Column, count: Column) -> Column:
    return F.try_divide(total / 1000, count)


def _grouped(df: DataFrame, dims: Sequence[str], *measures: Column) -> DataFrame:
    """One aggregate per minute and dimensions, on tables and streams alike."""
    windowed, key = tumble(df)
    grouped = windowed.groupBy(*key, *dims).agg(*measures)
    names = [c for c in grouped.columns if c not in key]
    return grouped.select(window_bounds(grouped)[0], *names)


def _timed(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per minute and dimensions: records with a latency, its sum and maximum."""
    return _grouped(
        df,
        dims,
        F.count("latency_ms").alias("n"),
        F.sum(F.col("latency_ms").cast("double")).alias("total"),
        F.max("latency_ms").alias("high"),
    )


def consume_latency(consume: DataFrame) -> DataFrame:
    """Consume markers with the time from origin to consumption."""
    return with_latency(consume).withColumnRenamed("consumed_topic", "this_topic")


def counted(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Records per minute and dimensions."""
    return _grouped(df, dims, F.count(F.lit(1)).alias("records"))


def average_latency(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Average latency in seconds per minute and dimensions."""
    return _timed(df, dims).select(
        "window_start", *dims, _seconds(F.col("total"), F.col("n")).alias("avg_seconds")
    )


def maximum_latency(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Highest latency in seconds per minute and dimensions."""
    return _timed(df, dims).select("window_start", *dims, (F.col("high") / 1000).alias("max_seconds"))


def failure_ratio(produce: DataFrame, size_ms: int = FIVE_MINUTES) -> DataFrame:
    """Share of sends that failed, per service; needs a ``status`` column."""
    minutes = _grouped(
        produce,
        ["this_service"],
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") != "success").alias("failed"),
    )
    ratio = F.sum("failed") / F.greatest(F.sum("n"), F.lit(TINY))
    return slide(minutes, size_ms).groupBy("window_start", "this_service").agg(ratio.alias("failure_ratio"))


def completion_share(
    produce: DataFrame, depth: int = 3, size_ms: int = FIVE_MINUTES
) -> DataFrame:
    """Share of records that are at the terminal hop."""
    at_depth = F.count_if(F.col("hop_count") == depth).alias("deep")
    minutes = _grouped(produce, [], F.count(F.lit(1)).alias("n"), at_depth)
    share = F.sum("deep") / F.greatest(F.sum("n"), F.lit(TINY))
    return slide(minutes, size_ms).groupBy("window_start").agg(share.alias("completion_share"))


def lagging_consumers(
    consume: DataFrame, above_seconds: float = 30.0, size_ms: int = FIVE_MINUTES
) -> DataFrame:
    """Consumers whose records are older than the limit on average."""
    minutes = _timed(consume_latency(consume), ["consumer_service"])
    return (
        slide(minutes, size_ms)
        .groupBy("window_start", "consumer_service")
        .agg(_seconds(F.sum("total"), F.sum("n")).alias("avg_age_seconds"))
        .where(F.col("avg_age_seconds") > above_seconds)
    )


def silent_services(
    produce: DataFrame, minutes: int = 2, dims: Sequence[str] = ("this_service",), as_of_ms: int | None = None
) -> DataFrame:
    """Windows of so many minutes, sliding by one, in which a known service sent
    nothing.

    Only the gaps between a service's active minutes are filled in, so there is
    no grid of all services and all windows. A service counts from its first
    record on, up to the last active minute of any service, or up to ``as_of_ms``,
    which also leaves out records stamped later than that. Further ``dims`` watch a
    service per pipeline, say. A gap becomes a row per hour first and per minute
    then, so no row holds more than sixty minutes at once.
    """
    step = wire.WINDOW_MS
    if as_of_ms is not None:
        produce = produce.where(event_ms() < as_of_ms)
    active = _grouped(produce, dims, F.lit(1).alias("one"))
    last_minute = active.agg(F.max("window_start")).scalar()
    following = F.lead("window_start").over(Window.partitionBy(*dims).orderBy("window_start"))
    gaps = active.select(
        *dims,
        (F.col("window_start") + step).alias("first_silent"),
        (F.coalesce(following, last_minute + step) - minutes * step).alias("last_silent"),
    ).where(F.col("last_silent") >= F.col("first_silent"))
    hour = 60 * step
    hours = gaps.select(
        "*",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.col("last_silent") - F.col("first_silent")) / hour)),
                lambda h: F.col("first_silent") + h * hour,
            )
        ).alias("from"),
    )
    return hours.select(
        *dims,
        F.explode(
            F.sequence("from", F.least("last_silent", F.col("from") + hour - step), F.lit(step))
        ).alias("window_start"),
    )


def drop_off(
    signal_rows: DataFrame, upstream: str, downstream: str, size_ms: int = FIVE_MINUTES
) -> DataFrame:
    """Records on a topic less records on the next one, as consumed and as produced."""
    on_these = signal_rows.where(F.col("this_topic").isin(upstream, downstream))
    sign = F.when(F.col("this_topic") == upstream, 1).otherwise(-1)
    is_produce = F.col("consumer_service").isNull()
    minutes = _grouped(
        on_these,
        [],
        F.sum(F.when(is_produce, 0).otherwise(sign)).alias("consumed"),
        F.sum(F.when(is_produce, sign).otherwise(0)).alias("produced"),
    )
    return slide(minutes, size_ms).groupBy("window_start").agg(
        F.sum("consumed").alias("consumed_drop"), F.sum("produced").alias("produced_drop")
    )


def end_to_end_latency(consume: DataFrame, terminal: str = wire.SHIPPING) -> DataFrame:
    """Average time from origin to the terminal consumer, per minute."""
    return average_latency(
        consume_latency(consume.where(F.col("consumer_service") == terminal)), []
    )


def at_hop_ceiling(
    produce: DataFrame, ceiling: int = wire.MAX_HOPS, size_ms: int = FIVE_MINUTES
) -> DataFrame:
    """Records that reached the hop cap."""
    minutes = counted(produce.where(F.col("hop_count") == ceiling), [])
    return slide(minutes, size_ms).groupBy("window_start").agg(F.sum("records").alias("records"))


def _against_earlier(df: DataFrame, shift_ms: int, *others: str) -> DataFrame:
    """Each row twice: as it is, and moved to the time it is compared with."""
    ages = F.array(
        F.struct(F.col("window_start").alias("at"), F.lit(True).alias("current")),
        F.struct((F.col("window_start") + shift_ms).alias("at"), F.lit(False).alias("current")),
    )
    return df.select(*others, F.explode(ages).alias("age")).select(
        *others, F.col("age.at").alias("window_start"), "age.current"
    )


def latency_change(
    produce: DataFrame, shift_ms: int = 2 * HOUR, size_ms: int = FIVE_MINUTES
) -> DataFrame:
    """Average latency in seconds now less the same some hours earlier.

    Shifting a copy of the window sums puts both times under one key, so the
    records are read and grouped once and nothing is joined.
    """
    windows = slide(_timed(produce, []), size_ms).groupBy("window_start").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    average = _seconds(F.col("total"), F.col("n"))
    compared = _against_earlier(windows.select("window_start", average.alias("avg")), shift_ms, "avg")
    return (
        compared.groupBy("window_start")
        .agg(
            F.max(F.when(F.col("current"), F.col("avg"))).alias("now_seconds"),
            F.max(F.when(~F.col("current"), F.col("avg"))).alias("earlier_seconds"),
        )
        .where(F.col("now_seconds").isNotNull() & F.col("earlier_seconds").isNotNull())
        .withColumn("change_seconds", F.col("now_seconds") - F.col("earlier_seconds"))
    )


def pass_through(
    signal_rows: DataFrame,
    intake_topic: str = wire.PLACED,
    terminal: str = wire.SHIPPING,
    size_ms: int = FIVE_MINUTES,
) -> DataFrame:
    """Records the terminal consumer took, per record produced at the intake."""
    taken = F.col("consumer_service").eqNullSafe(terminal)
    placed = F.col("consumer_service").isNull() & F.col("this_topic").eqNullSafe(intake_topic)
    minutes = _grouped(
        signal_rows.where(taken | placed),
        [],
        F.count_if(taken).alias("taken"),
        F.count_if(placed).alias("placed"),
    )
    return slide(minutes, size_ms).groupBy("window_start").agg(
        F.try_divide(F.sum("taken"), F.sum("placed")).alias("pass_through")
    )


def new_services(produce: DataFrame, shift_ms: int = HOUR) -> DataFrame:
    """Services active in a minute but not in the same minute some time earlier."""
    active = _grouped(produce, ["this_service"], F.lit(1).alias("one"))
    return (
        _against_earlier(active, shift_ms, "this_service")
        .groupBy("this_service", "window_start")
        .agg(F.bool_or("current").alias("now"), F.bool_and("current").alias("only_now"))
        .where(F.col("now") & F.col("only_now"))
        .select("this_service", "window_start")
    )


def pipelines(df: DataFrame) -> DataFrame:
    """The pipelines there are, to choose from."""
    return df.select("pipeline").where(F.col("pipeline").isNotNull()).distinct()


def in_pipelines(df: DataFrame, pattern: str) -> DataFrame:
    """Rows of the pipelines whose whole name matches a regular expression."""
    return df.where(F.coalesce("pipeline", F.lit("")).rlike(f"^(?:{pattern})$"))
