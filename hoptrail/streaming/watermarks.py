"""How late a record may be."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hoptrail import wire
from hoptrail.operators.views import fan_in


def with_watermark(raw: DataFrame, delay: str = wire.WATERMARK_DELAY) -> DataFrame:
    """One watermark over all topics: an idle topic does not hold results back,
    but one that lags by more than the delay loses its late records."""
    return raw.withWatermark("event_time", delay)


def watermark_each(*sources: DataFrame, delay: str = wire.WATERMARK_DELAY) -> DataFrame:
    """A watermark per topic; the slowest one decides. No topic's records are
    late because of another's, but an idle topic holds all results back."""
    return fan_in(*[with_watermark(source, delay) for source in sources])
