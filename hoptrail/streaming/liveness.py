"""Which services fell silent or are new, on a stream.

Records are first counted per service and minute, so a busy service brings a row per
minute to its state and not its records. Those rows leave the count when the watermark
has passed their minute, in whatever batches the stream runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hoptrail import wire
from hoptrail.shipping import ship

HOUR = 3_600_000


def active_minutes(produce: DataFrame, dims: Sequence[str]) -> DataFrame:
    """A row per minute and ``dims`` with a record, with ``minute`` in milliseconds."""
    counted = produce.groupBy(F.window("event_time", wire.WINDOW), *dims).agg(F.count(F.lit(1)).alias("records"))
    return counted.select(
        *dims, F.unix_millis("window.start").alias("minute"), F.window_time("window").alias("event_time")
    )


def _rows(dims: Sequence[str], key: tuple, **values) -> Row:
    return Row(**dict(zip(dims, key)), **values)


class Watch(StatefulProcessor):
    """Remembers a service's minutes that open windows may need; a timer at the end of
    the next window fires without input and tells whether the service was silent."""

    def __init__(self, dims: Sequence[str], minutes: int, forget_ms: int):
        self.dims, self.size, self.forget_ms = list(dims), minutes * wire.WINDOW_MS, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("watch", "next bigint, last bigint, ahead array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        came = sorted(row["minute"] for row in rows)
        if self.held.exists():
            following, last, ahead = self.held.get()
            ahead = sorted({*ahead, *came})
        else:
            following, last, ahead = came[0] + wire.WINDOW_MS, came[0], came[1:]
        self._keep(following, last, ahead)
        return iter(())

    def _keep(self, following: int, last: int, ahead: list[int]) -> None:
        self.held.update((following, last, ahead))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(following + self.size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, silent = timerValues.getCurrentWatermarkInMs(), []
        at, last, ahead = self.held.get()
        ahead, place = list(ahead), 0
        while at + self.size <= now:
            if place < len(ahead) and ahead[place] < at + self.size:
                last = ahead[place]
                at, place = last + wire.WINDOW_MS, place + 1
            elif at < last + self.forget_ms:
                silent.append(at)
                at += wire.WINDOW_MS
            elif place < len(ahead):
                # Forgotten in between, known again from its next record on.
                last = ahead[place]
                at, place = last + wire.WINDOW_MS, place + 1
            else:
                self.held.clear()
                return iter([_rows(self.dims, key, window_start=w) for w in silent])
        self._keep(at, last, ahead[place:])
        return iter([_rows(self.dims, key, window_start=w) for w in silent])

    def close(self) -> None:
        pass


def silent_services(
    produce: DataFrame, minutes: int = 2, dims: Sequence[str] = ("this_service",), forget_ms: int = HOUR
) -> DataFrame:
    """Windows of so many minutes, sliding by one, in which a known service sent
    nothing, each told when the watermark reaches its end. A service that stays silent
    for ``forget_ms`` is forgotten with its state and known again from its next record."""
    ship(produce.sparkSession)
    fields = ", ".join(f"{name} string" for name in dims)
    return active_minutes(produce, dims).groupBy(*dims).transformWithState(
        statefulProcessor=Watch(dims, minutes, forget_ms),
        outputStructType=f"{fields}, window_start bigint",
        outputMode="append",
        timeMode="eventTime",
    )


class Sightings(StatefulProcessor):
    """Remembers a service's minutes for as long as one may be compared with them."""

    def __init__(self, dims: Sequence[str], shift_ms: int, forget_ms: int):
        self.dims, self.shift_ms, self.forget_ms = list(dims), shift_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("seen", "minutes array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = list(self.held.get()[0]) if self.held.exists() else []
        out, known = [], set(held)
        for minute in sorted(row["minute"] for row in rows):
            first = not held or minute >= held[-1] + self.forget_ms
            if first or minute - self.shift_ms not in known:
                out.append(_rows(self.dims, key, window_start=minute, first=first))
            held.append(minute)
            known.add(minute)
        held = [m for m in held if m > held[-1] - self.shift_ms]
        self.held.update((held,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(held[-1] + self.forget_ms)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def new_services(
    produce: DataFrame,
    dims: Sequence[str] = ("this_service",),
    shift_ms: int = HOUR,
    forget_ms: int = 24 * HOUR,
) -> DataFrame:
    """Minutes in which a service is active and was not so ``shift_ms`` earlier;
    ``first`` tells its first appearance. State per service is the minutes of the last
    ``shift_ms``; it ends after ``forget_ms`` of silence, and the service is new again."""
    if forget_ms < shift_ms:
        raise ValueError("a service must be remembered for as long as it is compared with")
    ship(produce.sparkSession)
    fields = ", ".join(f"{name} string" for name in dims)
    return active_minutes(produce, dims).groupBy(*dims).transformWithState(
        statefulProcessor=Sightings(dims, shift_ms, forget_ms),
        outputStructType=f"{fields}, window_start bigint, first boolean",
        outputMode="append",
        timeMode="eventTime",
    )
