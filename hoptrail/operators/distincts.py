"""Distinct traces across days from sketches that combine like sets.

A day's traces become one theta sketch per dimensions, some tens of kilobytes however
many traces there are. Sketches of days, pipelines or topics unite, and the difference
of two estimates the traces seen here and not there, so a question over a year reads a
few sketches per day and no records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail import wire

LOG_ENTRIES = 13
# Three standard errors of a sketch of 2^13 entries, as a share of the united set.
ERROR = 3 / 2 ** (LOG_ENTRIES / 2)


def trace_sketches(produce: DataFrame, dims: Sequence[str] = ("pipeline", "this_topic")) -> DataFrame:
    """A sketch of the distinct traces per day and ``dims``. Partial sketches unite
    before the shuffle, so a busy topic is a few rows."""
    day = F.to_date("event_time").alias("day")
    return produce.groupBy(day, *dims).agg(F.theta_sketch_agg("trace_id", LOG_ENTRIES).alias("traces"))


def distinct_traces(sketches: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Estimated distinct traces per ``dims`` over all the sketches given."""
    united = F.theta_union_agg("traces", LOG_ENTRIES)
    return sketches.groupBy(*dims).agg(F.theta_sketch_estimate(united).alias("distinct_traces"))


def lost_between(sketches: DataFrame, topics: Sequence[str] = wire.STAGE_TOPICS) -> DataFrame:
    """Per pair of adjacent topics: estimated traces on the first, and on the first but
    never on the second, on whatever day."""

    def on(topic: str) -> Column:
        return F.theta_union_agg(F.when(F.col("this_topic") == topic, F.col("traces")), LOG_ENTRIES)

    united = sketches.agg(*[on(topic).alias(f"on_{i}") for i, topic in enumerate(topics)])
    pairs = [
        F.struct(
            F.lit(topics[i]).alias("from_topic"),
            F.lit(topics[i + 1]).alias("to_topic"),
            F.theta_sketch_estimate(f"on_{i}").alias("traces"),
            F.theta_sketch_estimate(F.theta_difference(f"on_{i}", f"on_{i + 1}")).alias("lost"),
        )
        for i in range(len(topics) - 1)
    ]
    return united.select(F.inline(F.array(*pairs)))


def within_error(estimated: str, exact: str, of: str, error: float = ERROR) -> Column:
    """Whether an estimate is as near as the sketches promise for a set of size ``of``."""
    return F.abs(F.col(estimated) - F.col(exact)) <= F.ceil(F.col(of) * error)
