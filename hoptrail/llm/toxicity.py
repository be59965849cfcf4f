"""Toxicity: a factorisation machine over hashed terms.

Besides one weight per term the model learns a short vector per term. The product
of two vectors weighs the pair, so an insult near a group's name counts for more
than both alone, which additive weights cannot say. Terms are the distinct words of
a text and the beginnings of its words (4 to 9 bytes), as insults are inflected.

The sum over pairs is computed from sums of vectors, in time linear in the terms.
Weights and vectors are fitted by adaptive gradient steps on at most
``FITTING_ROWS`` labelled documents (whole texts), those with the smallest hash of
their id, as one task bounded by parameters. Terms of fewer than ``LEAST_TEXTS`` of
these documents are left out, and so are terms that are about as frequent in toxic
ones as in all, both among all texts and among those with any one telling term, so
chance decides nothing. A group's name that matters only beside an insult stays; a
pair of which neither term tells anything by itself is not learnt. Scoring covers every row in place, without a
shuffle.

Defined cases: null and empty texts have no terms and get the score of the
intercept; labels other than 0 and 1 are ignored, of several labels of a document
the larger counts; without labels every score is 0; repeated rows are each scored;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.quality_model import probability
from hoptrail.llm.quality_rules import _KINDS
from hoptrail.llm.sampling import fitting_rows, remainder
from hoptrail.llm.workers import ship

BUCKETS = 1 << 18
FACTORS = 8
FITTING_ROWS = 12_000
LEAST_TEXTS = 4
LEAST_DEVIATIONS = 4.0
PASSES = 12
BATCH = 32
RATE, DECAY, SPREAD = 0.1, 1e-3, 0.05
FOLDS, HELD_OUT, LEAST_SCORE = 4, 2, 0.3
BEGINNINGS = (4, 5, 6, 7, 8, 9)


def terms(piece: arrays.Piece, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of the distinct terms of each text."""
    start, end, text = arrays.runs((_KINDS[piece.data] == 1).view(np.uint8), piece.at)
    sums = arrays.prefix_sums(arrays.LOWER[piece.data])
    owners, found = [text], [arrays.span_hashes(sums, start, end)]
    for n in BEGINNINGS:
        long = end - start > n
        owners.append(text[long])
        found.append(arrays.mix(arrays.span_hashes(sums, start[long], start[long] + n) + np.uint64(n)))
    bucket = (np.concatenate(found) & np.uint64(buckets - 1)).astype(np.int64)
    keys = np.unique(np.concatenate(owners) * buckets + bucket)
    return keys // buckets, keys % buckets


class Machine:
    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    @staticmethod
    def _sums(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        return np.stack([np.bincount(owner, v, minlength=texts) for v in values.T], axis=1)

    def raw(self, owner: np.ndarray, found: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The score of each text before the logistic, and its sum of vectors."""
        vectors = self.factors[found]
        sums = self._sums(vectors, owner, texts)
        pairs = 0.5 * ((sums**2).sum(axis=1) - self._sums(vectors**2, owner, texts).sum(axis=1))
        return self.bias + np.bincount(owner, self.weights[found], minlength=texts) + pairs, sums


def telling_terms(rows: list[np.ndarray], y: np.ndarray, share: float, buckets: int) -> np.ndarray:
    """Which terms differ from the overall share of toxic texts beyond chance."""
    every = np.concatenate([np.zeros(0, np.int64), *rows])
    toxic = np.concatenate([np.zeros(0, np.int64), *(r for r, label in zip(rows, y) if label)])
    texts = np.bincount(every, minlength=buckets)
    apart = np.abs(np.bincount(toxic, minlength=buckets) - share * texts)
    return (texts >= LEAST_TEXTS) & (apart >= LEAST_DEVIATIONS * np.sqrt(texts * share * (1 - share)))


def terms_beside(rows: list[np.ndarray], y: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """The telling terms, and those that change the share of toxic texts beside one of
    them beyond chance. Every telling term asks all others again, so the bound grows
    with their number; one more text of variance keeps rare pairs from deciding."""
    kept = telling.copy()
    least = np.sqrt(LEAST_DEVIATIONS**2 + 2 * np.log(max(1, telling.sum())))
    every = np.concatenate([np.zeros(0, np.int64), *rows])
    owner = np.arange(len(rows)).repeat([len(r) for r in rows])[telling[every]]
    order = np.argsort(every[telling[every]], kind="stable")
    found, first = np.unique(every[telling[every]][order], return_index=True)
    for having in np.split(owner[order], first[1:]) if len(found) else []:
        share = y[having].mean()
        if 0 < share < 1:
            beside = np.concatenate([rows[i] for i in having])
            toxic = y[having].repeat([len(rows[i]) for i in having])
            texts = np.bincount(beside, minlength=len(telling))
            apart = np.abs(np.bincount(beside, toxic, minlength=len(telling)) - share * texts)
            spread = np.sqrt(texts * share * (1 - share) + 1)
            kept |= (texts >= LEAST_TEXTS) & (apart >= least * spread)
    return kept


def fit(rows: list[np.ndarray], y: np.ndarray, buckets: int) -> Machine:
    """A machine from the term buckets of labelled texts, in order."""
    share = np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9)
    telling = terms_beside(rows, y, telling_terms(rows, y, share, buckets))
    rows = [r[telling[r]] for r in rows]
    start = np.random.default_rng(7).normal(0.0, SPREAD, (buckets, FACTORS))
    start[~telling] = 0.0
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(buckets), start)
    seen_w, seen_v, seen_b = np.full(buckets, 1e-6), np.full((buckets, FACTORS), 1e-6), 1e-6
    for _ in range(PASSES):
        for first in range(0, len(rows), BATCH):
            part = rows[first : first + BATCH]
            owner = np.arange(len(part)).repeat([len(r) for r in part])
            found = np.concatenate(part)
            raw, sums = machine.raw(owner, found, len(part))
            miss = probability(raw) - y[first : first + BATCH]
            used, at = np.unique(found, return_inverse=True)
            slope = np.bincount(at, miss[owner], minlength=len(used)) + DECAY * machine.weights[used]
            own = machine.factors[used]
            pulls = machine._sums(miss[owner, None] * (sums[owner] - machine.factors[found]), at, len(used))
            pulls = pulls + DECAY * own
            seen_w[used] += slope**2
            seen_v[used] += pulls**2
            seen_b += miss.sum() ** 2
            machine.weights[used] -= RATE * slope / np.sqrt(seen_w[used])
            machine.factors[used] = own - RATE * pulls / np.sqrt(seen_v[used])
            machine.bias -= RATE * float(miss.sum()) / np.sqrt(seen_b)
    return machine


def fitted_machine(sample: DataFrame, buckets: int) -> Machine:
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, order = [], []
        for batch in batches:
            labels, turns, ids = (batch.column(c).to_pylist() for c in ("y", "turn", "doc_id"))
            for piece in arrays.pieces(batch.column("text")):
                text, found = terms(piece, buckets)
                cuts = np.searchsorted(text, np.arange(len(piece) + 1))
                rows += [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                at = range(piece.first, piece.first + len(piece))
                order += [(turns[i], ids[i], labels[i]) for i in at]
        turn = sorted(range(len(rows)), key=order.__getitem__)
        machine = fit([rows[i] for i in turn], np.array([order[i][2] for i in turn], float), buckets)
        packed = np.column_stack([machine.weights, machine.factors]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([machine.bias]), pa.array([packed.tobytes()])], ["bias", "packed"]
        )

    found = sample.repartition(1).mapInArrow(learn, "bias double, packed binary").first()
    if found is None:
        return fit([], np.zeros(0), buckets)
    packed = np.frombuffer(found["packed"], np.float32).reshape(buckets, FACTORS + 1)
    return Machine(found["bias"], packed[:, 0].astype(float), packed[:, 1:].astype(float))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, most_rows: int = FITTING_ROWS
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    spark = ship(docs.sparkSession)
    allowed = remainder("doc_id", FOLDS) != HELD_OUT
    machine = fitted_machine(fitting_rows(docs, labels, "toxic", allowed, most_rows), buckets)
    shared = spark.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*shared.value)
        for batch in batches:
            for piece in arrays.pieces(batch.column("text")):
                raw, _ = own.raw(*terms(piece, buckets), len(piece))
                ids = batch.column("doc_id").slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([ids, pa.array(probability(raw))], ["doc_id", "score"])

    return (
        docs.select("doc_id", "text")
        .mapInArrow(score, "doc_id long, score double")
        .select(
            "doc_id",
            F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
        )
    )
