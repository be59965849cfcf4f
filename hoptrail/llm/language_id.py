"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read as UTF-8 bytes in segments of ``SEGMENT``, every byte of a text once.
One network reads a segment forwards and one backwards; both states together give
every position its probabilities of the languages, and a document's probabilities are
the mean over all its positions. The network is trained here, in numpy, by
backpropagation through time, on the label of the document at every position.

Training takes at most ``FITTING_ROWS`` documents per language, those with the smallest
hash of their id, and of each at most ``FITTING_SEGMENTS`` segments spread evenly over
the text. It runs as one task; its input and result are bounded by these parameters.
Prediction covers every row in place, without a shuffle, whole texts included.

Defined cases: texts that are null or have no letter are ``und`` with score 0, as are
all where no language is learnt; rows without doc_id are predicted and not learnt from;
rows that repeat a doc_id are predicted each and learnt from once; of several languages
of one doc_id each counts as a document; ties go to the language that sorts first; an
empty table gives an empty table.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.sampling import remainder
from hoptrail.llm.spool import spool
from hoptrail.llm.workers import ship

UNKNOWN = "und"
STATE = 16
SEGMENT = 128
SEGMENTS_AT_ONCE = 2_048
FITTING_ROWS = 300
FITTING_SEGMENTS = 8
SALTS = 32
PASSES = 3
BATCH = 128
RATE, DECAY, SQUARES_DECAY, LONGEST_STEP = 0.015, 0.9, 0.999, 1.0
FOLDS, HELD_OUT = 3, 1


def squash(a: np.ndarray) -> np.ndarray:
    """``a / (1 + |a|)`` in place, from -1 to 1; far cheaper than a tangent."""
    below = np.abs(a)
    below += 1
    a /= below
    return a


def gate(a: np.ndarray) -> np.ndarray:
    """The same from 0 to 1."""
    a = squash(a)
    a += 1
    a *= 0.5
    return a


def slope(squashed: np.ndarray) -> np.ndarray:
    """Derivative of ``squash`` where it gave these values."""
    return (1 - np.abs(squashed)) ** 2


class Reader:
    """One direction: per-byte input weights and recurrent weights of a gated cell.

    ``z`` keeps the old state, ``r`` lets it into the proposed one.
    """

    def __init__(self, inputs: np.ndarray, recurrent: np.ndarray):
        self.inputs, self.recurrent = inputs, recurrent
        self.size = len(recurrent)

    def step(self, state: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        n = self.size
        given, held = self.inputs.take(codes, axis=0), state @ self.recurrent
        gates = gate(given[:, : 2 * n] + held[:, : 2 * n])
        z, r = gates[:, :n], gates[:, n:]
        proposed = r * held[:, 2 * n :]
        proposed += given[:, 2 * n :]
        squash(proposed)
        after = state - proposed
        after *= z
        after += proposed
        return after, z, r, proposed, held

    def read(self, codes: np.ndarray, real: np.ndarray | None, order) -> Iterator[tuple[int, np.ndarray]]:
        """Time and state after each step; where ``real`` is 0 the state is empty."""
        state = np.zeros((codes.shape[1], self.size), np.float32)
        for t in order:
            state = self.step(state, codes[t])[0]
            if real is not None:
                state *= real[t][:, None]
            yield t, state

    def trace(self, codes: np.ndarray, real: np.ndarray, order) -> list[tuple]:
        """All that the way back needs, in the order of reading."""
        state, out = np.zeros((codes.shape[1], self.size), np.float32), []
        for t in order:
            after, z, r, proposed, held = self.step(state, codes[t])
            after *= real[t][:, None]
            out.append((t, state, after, z, r, proposed, held))
            state = after
        return out

    def back(self, codes: np.ndarray, real: np.ndarray, trace: list[tuple], given: np.ndarray) -> list[np.ndarray]:
        """Gradients of the input and recurrent weights, from those of all states."""
        n = self.size
        inputs, recurrent = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        later = np.zeros_like(trace[0][1])
        for t, before, _, z, r, proposed, held in reversed(trace):
            whole = (later + given[t]) * real[t][:, None]
            d_proposed = whole * (1 - z) * slope(proposed)
            d_z = whole * (before - proposed) * slope(2 * z - 1) / 2
            d_r = d_proposed * held[:, 2 * n :] * slope(2 * r - 1) / 2
            np.add.at(inputs, codes[t], np.concatenate([d_z, d_r, d_proposed], axis=1))
            d_held = np.concatenate([d_z, d_r, d_proposed * r], axis=1)
            recurrent += before.T @ d_held
            later = whole * z + d_held @ self.recurrent.T
        return [inputs, recurrent]


class Network:
    """Two readers and the weights that turn their states into languages."""

    def __init__(self, languages: list[str], weights: list[np.ndarray]):
        self.languages, self.weights = languages, weights
        self.forth, self.back = Reader(*weights[0:2]), Reader(*weights[2:4])

    @staticmethod
    def fresh(languages: list[str], size: int = STATE, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        one = lambda: [draw(256, 3 * size, scale=0.3), draw(size, 3 * size, scale=size**-0.5)]
        out = [draw(2 * size, len(languages), scale=0.1), np.zeros(len(languages), np.float32)]
        return Network(languages, [*one(), *one(), *out])

    def dump(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, *self.weights)
        return held.getvalue()

    @staticmethod
    def load(languages: list[str], data: bytes) -> Network:
        held = np.load(io.BytesIO(data))
        return Network(languages, [held[name] for name in held.files])

    def pooled(self, codes: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Probabilities of all positions, summed per segment."""
        size, weights, bias = self.forth.size, *self.weights[4:]
        short = None if real.all() else real
        states = np.empty((*codes.shape, size), np.float32)
        for t, state in self.forth.read(codes, short, range(len(codes))):
            states[t] = state
        out = np.zeros((codes.shape[1], len(bias)), np.float32)
        for t, state in self.back.read(codes, short, range(len(codes))[::-1]):
            found = softmax(states[t] @ weights[:size] + state @ weights[size:] + bias)
            out += found if short is None else found * real[t][:, None]
        return out

    def gradients(self, codes: np.ndarray, real: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions and its gradients."""
        size, weights, bias = self.forth.size, *self.weights[4:]
        forth = self.forth.trace(codes, real, range(len(codes)))
        back = self.back.trace(codes, real, range(len(codes))[::-1])
        states = np.zeros((*codes.shape, 2 * size), np.float32)
        for t, *rest in forth:
            states[t, :, :size] = rest[1]
        for t, *rest in back:
            states[t, :, size:] = rest[1]
        found = softmax(states @ weights + bias)
        total, each = real.sum(), np.arange(len(label))
        loss = -(np.log(found[:, each, label] + 1e-9) * real).sum() / total
        miss = found
        miss[:, each, label] -= 1
        miss *= (real / total)[:, :, None]
        d_states = miss @ weights.T
        flat = miss.reshape(-1, len(bias))
        return loss, [
            *self.forth.back(codes, real, forth, d_states[:, :, :size]),
            *self.back.back(codes, real, back, d_states[:, :, size:]),
            states.reshape(-1, 2 * size).T @ flat,
            flat.sum(axis=0),
        ]


def softmax(a: np.ndarray) -> np.ndarray:
    a -= a.max(axis=-1, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(axis=-1, keepdims=True)
    return a


def train(network: Network, codes: np.ndarray, real: np.ndarray, label: np.ndarray, passes: int = PASSES) -> list[float]:
    """Adaptive steps over shuffled batches of segments; gives the losses."""
    first = [np.zeros_like(w) for w in network.weights]
    second = [np.zeros_like(w) for w in network.weights]
    rng, losses = np.random.default_rng(1), []
    for turn in range(passes):
        order = rng.permutation(len(label))
        for begin in range(0, len(order), BATCH):
            at = order[begin : begin + BATCH]
            loss, slopes = network.gradients(codes[:, at], real[:, at], label[at])
            losses.append(float(loss))
            length = np.sqrt(sum(float((s * s).sum()) for s in slopes))
            shrink, step = min(1.0, LONGEST_STEP / (length + 1e-9)), len(losses)
            rate = RATE * (1 - turn / passes) * np.sqrt(1 - SQUARES_DECAY**step) / (1 - DECAY**step)
            for w, s, m, v in zip(network.weights, slopes, first, second):
                s = s * shrink
                m += (1 - DECAY) * (s - m)
                v += (1 - SQUARES_DECAY) * (s * s - v)
                w -= (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return losses


def segments(piece: arrays.Piece, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the segments that make up each text."""
    counts = -(-np.diff(piece.at) // size)
    owner = np.arange(len(piece)).repeat(counts)
    nth = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    start = piece.at[owner] + nth * size
    return start, np.minimum(start + size, piece.at[owner + 1]), owner


def by_time(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as [time, segment], and 1 where a segment has one."""
    place = start[None] + np.arange(size)[:, None]
    real = place < end[None]
    return np.where(real, data[np.minimum(place, max(0, len(data) - 1))], 0), real.astype(np.float32)


def probabilities(network: Network, piece: arrays.Piece) -> np.ndarray:
    """Pooled probabilities per text; texts without bytes have zeros."""
    start, end, owner = segments(piece)
    out = np.zeros((len(piece), len(network.languages)))
    for first in range(0, len(start), SEGMENTS_AT_ONCE):
        at = slice(first, first + SEGMENTS_AT_ONCE)
        np.add.at(out, owner[at], network.pooled(*by_time(piece.data, start[at], end[at])))
    return out / np.maximum(1, np.diff(piece.at))[:, None]


def training_rows(docs: DataFrame, most: int) -> DataFrame:
    """``doc_id``, ``lang`` and ``text`` of at most ``most`` documents per language."""
    allowed = (remainder("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & (F.length("text") > 0)
    usable = docs.select("doc_id", "lang", "text").where(allowed)
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = usable.select("doc_id", "lang").distinct().withColumn("salt", F.pmod("doc_id", F.lit(SALTS)))
    # The first of each salt, then the first of all: a common language is no single task.
    for dims in (("lang", "salt"), ("lang",)):
        nth = F.row_number().over(Window.partitionBy(*dims).orderBy(*order))
        picked = picked.withColumn("nth", nth).where(F.col("nth") <= most).drop("nth")
    picked = spool(picked.drop("salt"))
    return usable.join(F.broadcast(picked), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def trained(rows: DataFrame, passes: int = PASSES) -> Network | None:
    """The network learnt from the rows in one task; none without rows."""
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return None

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: i for i, lang in enumerate(languages)}
        parts = []
        for batch in batches:
            label = np.array([number[x] for x in batch.column("lang").to_pylist()])
            ids = batch.column("doc_id").to_numpy()
            for piece in arrays.pieces(batch.column("text")):
                start, end, owner = segments(piece)
                counts = np.bincount(owner, minlength=len(piece))
                nth = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
                take = np.minimum(counts, FITTING_SEGMENTS)[owner]
                used = nth * take // counts[owner] != (nth - 1) * take // counts[owner]
                owner, nth = owner[used], nth[used]
                codes, real = by_time(piece.data, start[used], end[used])
                parts.append((codes.astype(np.uint8), real, label[piece.first + owner], ids[piece.first + owner], nth))
        codes, real, label, ids, nth = (np.concatenate(p, axis=-1) for p in zip(*parts))
        order = np.lexsort((nth, label, ids))
        network = Network.fresh(languages)
        train(network, codes[:, order], real[:, order], label[order], passes)
        yield pa.RecordBatch.from_arrays([pa.array([network.dump()])], ["weights"])

    return Network.load(languages, rows.repartition(1).mapInArrow(learn, "weights binary").first()["weights"])


def identify_language(docs: DataFrame, most_rows: int = FITTING_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document."""
    spark = ship(docs.sparkSession)
    network = trained(spool(training_rows(docs, most_rows)))
    shared = spark.sparkContext.broadcast((network.languages, network.weights) if network else ([], []))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights = shared.value
        network = Network(languages, weights) if languages else None
        for batch in batches:
            for piece in arrays.pieces(batch.column("text")):
                ids = batch.column("doc_id").slice(piece.first, len(piece))
                found = probabilities(network, piece) if network else np.zeros((len(piece), 1))
                best = found.argmax(axis=1)
                names = pa.array([languages[i] for i in best] if network else [UNKNOWN] * len(piece), pa.string())
                score = pa.array(np.clip(found[np.arange(len(piece)), best], 0.0, 1.0))
                yield pa.RecordBatch.from_arrays([ids, names, score], ["doc_id", "lang_pred", "score"])

    # A text without a letter is not read at all.
    told = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    source = docs.select("doc_id", F.when(told, F.col("text")).otherwise("").alias("text"))
    found = source.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    unread = F.col("score") == 0
    return found.select(
        "doc_id",
        F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.when(unread, F.lit(UNKNOWN)).otherwise(F.col("lang_pred")).alias("lang_pred"),
        "score",
    )
