"""Texts that every operator must cope with, and plain readings of the contracts."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 8000
EDGES = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the slow old bear again", "src0", 7),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the slow old bear again", "src0", 7),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the slow old bear again", "src0", 7),
    (3, None, None, None),
    (4, "", "src1", 0),
    (5, " \t\n ", None, 4),
    (6, LONG, "src0", 1),
    (7, "x" * 50000, "src0", 1),
    (8, "É ß 漢字 😀\x0b\x0cend\r\nline\n\nline", "src2", 1),
    (None, "a row without an id but with text", "src2", 1),
]
# Columns beyond those an operator reads, named like what operators write.
SCHEMA = "doc_id long, text string, score string, kept long"


def edge_documents(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark, folder):
    return sorted(tuple(r) for r in read(spark, folder, "documents").select("doc_id", "text").collect())


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
