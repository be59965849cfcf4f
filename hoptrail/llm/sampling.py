"""Labelled documents for fitting, in a bounded number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.spool import spool


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def fitting_rows(docs: DataFrame, labels: DataFrame, label: str, allowed, most: int) -> DataFrame:
    """``text`` and ``y`` of at most ``most`` labelled rows, those with the smallest
    hash of their id, in that order. ``allowed`` is the condition on the labels."""
    picked = spool(
        labels.where(allowed & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .select(F.xxhash64("doc_id").alias("turn"), "doc_id", "text", "y")
    )
