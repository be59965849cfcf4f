"""Quality rules: a hashed n-gram log-likelihood ratio with fixed thresholds.

Two multinomials over hashed token unigrams and bigrams are counted: one over the
texts of a trusted target, one over the whole raw corpus. A text's score is the
mean log ratio of the two over its n-grams, so long and short texts compare. A
text is kept when its score reaches the threshold and it passes the base rules.

Both counts get the same prior mass per bucket, the raw ones after scaling to the
size of the target. An n-gram the target happens to lack thus weighs little when
it is rare and much when it is common. Only the bucket table, whose size is fixed
by ``buckets``, passes through the driver.

Defined cases: a null text is empty; an empty text has zero counts, score 0 and
fails the base rules; repeated rows are each judged and counted; an empty target
gives every n-gram the score 0; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.workers import ship

BUCKETS = 1 << 18
PRIOR = 4.0
LEAST_SCORE = -0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_KINDS = np.full(256, 1, np.uint8)
_KINDS[:128] = [0 if arrays.SPACE[b] else 1 if chr(b).isalnum() or b == 0x5F or b < 0x20 else 2 for b in range(128)]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True

_COUNTS = "bucket int, raw long, target long"
_SCORED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
)


def ngram_buckets(piece: arrays.Piece, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every token and token pair. Tokens are runs of
    letters and digits or of punctuation, with A-Z lowered."""
    start, end, text = arrays.runs(_KINDS[piece.data], piece.at)
    tokens = arrays.span_hashes(arrays.prefix_sums(arrays.LOWER[piece.data]), start, end)
    pairs, at = arrays.sequences(tokens, text, 2)
    low = np.uint64(buckets - 1)
    return (
        np.concatenate([tokens & low, arrays.mix(pairs) & low]).astype(np.int64),
        np.concatenate([text, text[at]]),
    )


def ngram_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Counts per bucket over all texts and over those with ``target`` set."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            trusted = batch.column("target").to_numpy(zero_copy_only=False)
            for piece in arrays.pieces(batch.column("text")):
                found, text = ngram_buckets(piece, buckets)
                raw += np.bincount(found, minlength=buckets)
                target += np.bincount(found[trusted[piece.first + text]], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
            ["bucket", "raw", "target"],
        )

    return texts.select("text", "target").mapInArrow(count, _COUNTS).groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> np.ndarray:
    """The log ratio of each bucket; zero where nothing was seen."""
    table = counts.toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[table["bucket"].to_numpy()] = table["raw"].to_numpy()
    target[table["bucket"].to_numpy()] = table["target"].to_numpy()
    if not target.sum():
        return np.zeros(buckets)
    return np.log((target + prior) / (raw * (target.sum() / raw.sum()) + prior))


def base_counts(piece: arrays.Piece) -> dict[str, np.ndarray]:
    n = len(piece)
    start, end, text = arrays.words(piece)
    word = arrays.span_hashes(arrays.prefix_sums(piece.data), start, end)
    windows, at = arrays.sequences(word, text, 3)
    keys = arrays.mix(windows + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys) + 1, bool)
    twice[order[:-1][same]] = True
    twice[order[1:][same]] = True
    repeated = np.zeros(len(word), bool)
    hit = at[twice[:-1]]
    for k in range(3):
        repeated[hit + k] = True
    sums = lambda marks: np.diff(np.concatenate([[0], np.cumsum(marks)])[piece.at])
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": sums(((piece.data & 0xC0) != 0x80) & ~arrays.SPACE[piece.data]),
        "n_symbols": sums(_SYMBOL[piece.data]),
        "n_dup_lines": np.array([_repeated_lines(piece, i) for i in range(n)], np.int64),
        "n_repeat_words": np.bincount(text[repeated], minlength=n),
    }


def _repeated_lines(piece: arrays.Piece, i: int) -> int:
    lines = [x for x in piece.data[piece.at[i] : piece.at[i + 1]].tobytes().split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def score_texts(docs: DataFrame, ratios: np.ndarray, keep: list[str], text_in: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row with its base counts and score. The text is
    read from the struct ``text_in`` if it is kept as a part of that anyway."""
    buckets = len(ratios)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            texts = batch.column(text_in).field("text") if text_in else batch.column("_scored_text")
            for piece in arrays.pieces(texts):
                n = len(piece)
                base = base_counts(piece)
                found, text = ngram_buckets(piece, buckets)
                total = np.bincount(text, weights[found], minlength=n)
                mean = total / np.maximum(1, np.bincount(text, minlength=n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(piece.first, n) for c in keep]
                    + [pa.array(x.astype(np.int64)) for x in base.values()]
                    + [pa.array(mean)],
                    [*keep, *base, "score"],
                )

    texts = [] if text_in else [F.col("text").alias("_scored_text")]
    return docs.select(*keep, *texts).mapInArrow(score, f"{schema}, {_SCORED}")


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str] | None = None,
    least_score: float = LEAST_SCORE,
    buckets: int = BUCKETS,
    prior: float = PRIOR,
    text_in: str | None = None,
) -> DataFrame:
    """Judge every document. The trusted target is the documents of ``docs`` that
    ``labels`` marks with quality 1; as labels grow with the corpus, the two meet by
    a shuffle at any size. ``keep`` names columns to carry along, ``text_in`` one of
    them that holds the text."""
    ship(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    trusted = labels.where("quality = 1").select("doc_id").distinct().withColumn("target", F.lit(True))
    flagged = docs.select("doc_id", "text").join(trusted.hint("shuffle_hash"), "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target")
    )
    ratios = log_ratios(ngram_counts(flagged, buckets), buckets, prior)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        score_texts(docs, ratios, keep, text_in)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("score") >= least_score))
    )
