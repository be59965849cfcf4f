"""How many rows each query dropped because they came behind its watermark."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def _dropped(progress) -> int:
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)


def dropped_rows(query: StreamingQuery) -> int:
    """Late rows of the batches that a query still remembers. Grouped rows count once
    per group and batch, as they reach the state."""
    return sum(_dropped(progress) for progress in query.recentProgress)


class LateRows(StreamingQueryListener):
    """Sums of late rows per query name over its whole run; add it with
    ``spark.streams.addListener``."""

    def __init__(self):
        self.rows: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        self.rows[event.name or str(event.id)] += 0

    def onQueryProgress(self, event) -> None:
        self.rows[event.progress.name or str(event.progress.id)] += _dropped(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per query, to be written beside the reports."""
        return spark.createDataFrame(sorted(self.rows.items()), "query string, late_rows bigint")
