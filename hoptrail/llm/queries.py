"""The queries of the numbered operators over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.llm import (
    bpe,
    centroids,
    chunks,
    decontaminate,
    hard_negatives,
    html_text,
    language_id,
    near_dedup,
    oracles,
    personal_data,
    quality_model,
    quality_rules,
    repeats,
    toxicity,
)

RANK_FILE = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))


def op3_benchmark_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.dedup_chunks(table(spark, folder, "documents")).drop("kept")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    return bpe.encode_texts(table(spark, folder, "documents"), ranks, pattern, ["doc_id"])


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), words=2)


def op7_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, folder, "documents"), ["doc_id"])
    return personal_data.span_columns(found)


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_report(table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(table(spark, folder, "embeddings").withColumn("label", shifted))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_language(table(spark, folder, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_quality_rules,
        op2_html_text,
        op3_benchmark_windows,
        op4_chunk_dedup,
        op5_byte_bpe,
        op6_near_dedup,
        op7_quality_model,
        op8_toxicity,
        op9_repeated_strings,
        op10_personal_data,
        op11_centroids,
        op12_hard_negatives,
        op13_language,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_benchmark_windows": oracles.BENCHMARK_WINDOWS,
    "op6_near_dedup": oracles.NEAR_DEDUP,
    "op9_repeated_strings": oracles.REPEATED_STRINGS,
    "op11_centroids": oracles.CENTROID_CLUSTERS,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
}
