"""Quality classifier: hashed word n-grams, logistic regression fitted by
follow-the-regularised-leader updates, scored as sparse dot products.

Fitting takes at most ``FITTING_ROWS`` labelled documents (whole texts), those with
the smallest hash of their id, and runs as one task over them; its input and its
result, one weight per bucket, are bounded by parameters. Scoring covers every row
in place, without a shuffle.

Defined cases: null and empty texts have no features and get the score of the
intercept; labels other than 0 and 1 are ignored, of several labels of a document
the larger counts; without labels every score is 0.5; repeated rows are each
scored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.quality_rules import ngram_buckets
from hoptrail.llm.sampling import fitting_rows, remainder
from hoptrail.llm.workers import ship

BUCKETS = 1 << 18
FITTING_ROWS = 12_000
PASSES = 5
BATCH = 32
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.1, 1.0
SAME_WORD_TWICE = 0x5A5A5A
FOLDS, HELD_OUT = 3, 1


class Leader:
    """Follow-the-regularised-leader state: sums of gradients and of their squares."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / pull, 0.0)

    def update(self, at: np.ndarray, gradient: np.ndarray) -> None:
        squares = gradient * gradient
        before = self.n[at]
        sigma = (np.sqrt(before + squares) - np.sqrt(before)) / ALPHA
        self.z[at] += gradient - sigma * self.weights(at)
        self.n[at] = before + squares


def features(piece: arrays.Piece, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and value of the sparse features of a piece: tokens, token
    pairs, and the pair of any word with itself as a feature of its own. Values are
    counts, dampened and scaled to unit length per text."""
    found, text = ngram_buckets(piece, buckets)
    start, end, owner = arrays.words(piece)
    word = arrays.span_hashes(arrays.prefix_sums(piece.data), start, end)
    twice = owner[1:][(word[1:] == word[:-1]) & (owner[1:] == owner[:-1])]
    found = np.concatenate([found, np.full(len(twice), SAME_WORD_TWICE % buckets)])
    text = np.concatenate([text, twice])
    keys, counts = np.unique(text * buckets + found, return_counts=True)
    text, found = keys // buckets, keys % buckets
    values = 1.0 + np.log(counts)
    norms = np.sqrt(np.bincount(text, values * values, minlength=len(piece)))
    return text, found, values / norms[text]


def probability(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, buckets: int) -> np.ndarray:
    """Weights, the intercept last, from feature rows (buckets, values) in order."""
    leader = Leader(buckets + 1)
    for _ in range(PASSES):
        for first in range(0, len(rows), BATCH):
            part = rows[first : first + BATCH]
            sizes = np.array([len(f) for f, _ in part])
            owner = np.arange(len(part)).repeat(sizes)
            found = np.concatenate([f for f, _ in part])
            values = np.concatenate([v for _, v in part])
            used, at = np.unique(found, return_inverse=True)
            z = np.bincount(owner, leader.weights(used)[at] * values, minlength=len(part))
            miss = probability(z + leader.weights(np.array([buckets]))[0]) - y[first : first + BATCH]
            leader.update(used, np.bincount(at, miss[owner] * values, minlength=len(used)))
            leader.update(np.array([buckets]), np.array([miss.sum()]))
    return leader.weights(slice(None))


def fitted_weights(sample: DataFrame, buckets: int) -> np.ndarray:
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, order = [], []
        for batch in batches:
            labels, turns, ids = (batch.column(c).to_pylist() for c in ("y", "turn", "doc_id"))
            for piece in arrays.pieces(batch.column("text")):
                text, found, values = features(piece, buckets)
                cuts = np.searchsorted(text, np.arange(len(piece) + 1))
                for i in range(len(piece)):
                    at = slice(cuts[i], cuts[i + 1])
                    rows.append((found[at].astype(np.int32), values[at].astype(np.float32)))
                    order.append((turns[piece.first + i], ids[piece.first + i], labels[piece.first + i]))
        turn = sorted(range(len(rows)), key=order.__getitem__)
        weights = fit([rows[i] for i in turn], np.array([order[i][2] for i in turn], float), buckets)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()])], ["weights"])

    found = sample.repartition(1).mapInArrow(learn, "weights binary").first()
    return np.frombuffer(found["weights"], np.float32).astype(float) if found else np.zeros(buckets + 1)


def score_quality(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, most_rows: int = FITTING_ROWS
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    spark = ship(docs.sparkSession)
    allowed = remainder("doc_id", FOLDS) != HELD_OUT
    sample = fitting_rows(docs, labels, "quality", allowed, most_rows)
    shared = spark.sparkContext.broadcast(fitted_weights(sample, buckets))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for piece in arrays.pieces(batch.column("text")):
                text, found, values = features(piece, buckets)
                z = np.bincount(text, weights[found] * values, minlength=len(piece)) + weights[-1]
                ids = batch.column("doc_id").slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([ids, pa.array(probability(z))], ["doc_id", "score"])

    return (
        docs.select("doc_id", "text")
        .mapInArrow(score, "doc_id long, score double")
        .select(
            "doc_id",
            F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
