"""From raw documents to token ids, one stage after the other.

Every stage takes the documents that its predecessor kept, with all their columns,
and its decisions take effect: rejected documents, copies and documents that quote a
benchmark go, personal data is replaced by its kind. The last stage returns ids.

Defined cases: null and empty texts fail the quality rules, so no later stage sees them.
Rows without doc_id are judged and redacted, but are nobody's copy and cannot be named
as a leak. Rows that repeat a doc_id go or stay together. Further columns are carried
along whatever their names; an empty table gives an empty table. Tables between and
within the stages are removed as soon as the next stage has its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.llm import bpe, decontaminate, near_dedup, personal_data, quality_rules
from hoptrail.llm.spool import discard, passing, spool, without_ids

RANK_FILE = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole_rows(docs: DataFrame) -> DataFrame:
    """Rows as one column, so that no name can clash, beside what is judged."""
    return docs.select(F.struct("*").alias("_doc"), "doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log ratio."""
    labels = _table(spark, sf_dir, "labels")
    judged = quality_rules.quality_rules(_whole_rows(docs), labels, keep=["_doc"], text_in="_doc")
    return judged.where("kept").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    with passing() as held:
        copies = spool(near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct())
        held.append(copies)
    return without_ids(docs, copies, "doc_id").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    with passing() as held:
        leaks = decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))
        leaking = spool(leaks.select("doc_id").distinct())
        held.append(leaking)
    return without_ids(docs, leaking, "doc_id").select(docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced, and their length as it is then."""
    found = personal_data.find_personal_data(_whole_rows(docs), ["_doc"])
    clean = found.withColumn("_text", personal_data.redacted_text("_doc.text", "spans"))
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return clean.select(*(changed.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number and digests."""
    ranks, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    return bpe.encode_texts(docs, ranks, pattern, ["doc_id"], with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", redaction),
    ("byte_bpe", tokens),
]

# Hashed n-grams, sketches and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = _table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with passing() as held:
            docs = spool(stage(spark, docs, sf_dir))
            held.append(docs)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
