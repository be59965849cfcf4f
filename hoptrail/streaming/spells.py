"""Stuck traces on a stream, exact live and on replay.

A spell is a run of records closer than the gap, kept as its first moment and its last
record. Spark's session windows hold a trace's open spells in order of event time, and a
record that arrives out of order joins, extends or bridges them. When the watermark
passes the end of a spell it gives its alert, so a single catch-up batch with hours of
records gives each of them, like a live stream does. State per trace is its open spells,
not its records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from hoptrail import wire
from hoptrail.operators.stuck import stuck_traces


def _order(last: tuple) -> tuple:
    """Later records are larger; ties go to the higher hop, then by name, nulls first."""
    return tuple((x is not None, x) for x in last)


def joined(spells: list[tuple], record: tuple, gap_ms: int) -> list[tuple]:
    """Spells with one more record, which begins with its moment: by hand, for tests to
    hold the windows against. A spell is (first_ms, last record); they stay in order and
    at least the gap apart."""
    seen = record[0]
    before = [s for s in spells if s[1][0] <= seen - gap_ms]
    after = [s for s in spells if s[0] >= seen + gap_ms]
    touched = spells[len(before) : len(spells) - len(after)]
    first = min([seen, *(s[0] for s in touched)])
    last = max([record, *(s[1] for s in touched)], key=_order)
    return [*before, (first, last), *after]


def stuck_spells(
    produce: DataFrame, gap_ms: int = wire.STUCK_AFTER_MS, terminal_topics: Sequence[str] = ()
) -> DataFrame:
    """Alerts of a watermarked produce stream, one per silent spell. Event times are whole
    milliseconds, as a log stamps them."""
    return stuck_traces(produce, gap_ms, terminal_topics)
