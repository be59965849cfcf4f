"""Trace ids: time-ordered 16-byte values, written as 32 hex digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_from_base64(text: Column) -> Column:
    return F.lower(F.hex(F.try_to_binary(text, F.lit("base64"))))


def id_to_base64(trace_id: Column) -> Column:
    return F.base64(F.unhex(trace_id))


def id_origin_ms(trace_id: Column) -> Column:
    """Creation time in the first 48 bits, so ordering by id is ordering by time."""
    return F.conv(F.substring(trace_id, 1, 12), 16, 10).try_cast("bigint")


def id_for_record(origin_ms: Column, *record: Column) -> Column:
    """A version-7 id whose random part is derived from the record's coordinates.

    Replaying the same record gives the same id, so a restarted job does not
    start a second trace for it.
    """
    digest = F.sha2(F.concat_ws("|", *[c.cast("string") for c in record]), 256)
    variant = F.element_at(
        F.array(*[F.lit(digit) for digit in "89ab"]),
        (F.conv(F.substring(digest, 4, 1), 16, 10).cast("int") % 4) + 1,
    )
    return F.concat(
        F.lpad(F.lower(F.hex(origin_ms)), 12, "0"),
        F.lit("7"),
        F.substring(digest, 1, 3),
        variant,
        F.substring(digest, 5, 15),
    )
