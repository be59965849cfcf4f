"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from hoptrail.session import shared_folder

_SCOPES: list[list[DataFrame]] = []


def spool(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` and read it back: it is computed once, survives the loss of
    executors and has sizes the planner knows. Spark removes it at its end, or
    :func:`passing` before. ``options`` go to the writer."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/hoptrail-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    system, target = _located(spark, path)
    system.deleteOnExit(target)
    table = spark.read.schema(df.schema).parquet(path)
    table._spooled_at = path
    if _SCOPES:
        _SCOPES[-1].append(table)
    return table


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``spool`` that nothing reads any more."""
    for table in tables:
        system, target = _located(table.sparkSession, table._spooled_at)
        system.delete(target, True)


@contextmanager
def passing() -> Iterator[list[DataFrame]]:
    """Remove the tables spooled inside, but for those put into the list it gives.
    What is made of them lazily must be spooled inside as well."""
    kept: list[DataFrame] = []
    _SCOPES.append([])
    try:
        yield kept
    finally:
        made = _SCOPES.pop()
        stay = {table._spooled_at for table in kept}
        discard(*(table for table in made if table._spooled_at not in stay))
        if _SCOPES:
            _SCOPES[-1].extend(kept)


def only_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids``. The join shuffles both, unless
    Spark itself finds one side below its own threshold for a broadcast."""
    return df.join(ids, column, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among ``ids``."""
    return df.join(ids, column, "left_anti")
