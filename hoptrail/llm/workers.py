"""Settings and code that Python workers need."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import SparkSession

from hoptrail import shipping

# Texts cross to Python in batches of so many bytes, however long they are.
BATCH_BYTES = 2 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package to the executors and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return shipping.ship(spark)


_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task: the value of one key, made when another
    or none is there."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def forget() -> None:
    """Drop what another operator left in this worker."""
    _HELD.clear()
