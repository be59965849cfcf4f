"""Centroid clustering with ns-bounds.

Rounds of assignment and update on integer vectors. A vector remembers, per
centroid, the squared distance when it was last evaluated and the round of that. All
former centroids are kept, so a bound loosens by the norm of the centroid's total
displacement since then, which is at most the sum of its drifts per round and often
far less. A vector whose own upper bound lies below all its other lower bounds stays
where it is without a look at its components. The others evaluate their own centroid
and then those whose lower bound reaches it, in whole numbers, ties to the smaller
number. Bounds are floating, with a margin far above their rounding.

A round writes the vectors with their memory to a table and removes the one before,
so no lineage grows and a lost executor costs a part of one round. Sums per centroid
change only by the vectors that moved. What passes through the driver is centroids:
``k`` x ``dims`` numbers per round.

Defined cases: vectors that are null, have another number of components or a null or
non-finite one take no part. Rows without vec_id are assigned but do not start a
centroid. Rows that repeat a vec_id are vectors of their own. With fewer rows than
``k`` each is a centroid. An empty table gives an empty table. Scaled components of
2^27 and more, whose distances might not fit a long, end the job with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.spool import discard, spool
from hoptrail.llm.workers import ship

CENTROIDS = 8
ROUNDS = 10
DIMS = 64
SCALE = 1024
SEED = 3

MOST_COMPONENT = 1 << 27
_SAFE = 1e-9
_STATE = "vec_id long, v array<long>, cluster int, was int, seen array<long>, at array<int>"


def whole_vectors(vectors: DataFrame, scale: int, dims: int | None = None) -> DataFrame:
    """Rows with a ``v`` of scaled, floored components; vectors that are null or have
    a null or non-finite component, or not ``dims`` of them, are left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = finite if dims is None else finite & (F.size("embedding") == dims)
    return vectors.where(fits).withColumn(
        "v", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column, all of one length, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def displacements(history: np.ndarray) -> np.ndarray:
    """How far each centroid lies from where it was in each round: [centroid, round]."""
    way = (history[-1][None] - history).astype(float)
    return np.sqrt((way * way).sum(axis=2)).T


def squared(v: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    way = v - centroid
    return np.einsum("ij,ij->i", way, way)


def reassign(
    v: np.ndarray, cluster: np.ndarray, seen: np.ndarray, at: np.ndarray, history: np.ndarray
) -> tuple[np.ndarray, int]:
    """Nearest centroids of the last round of ``history``, and how many distances that
    took. ``seen`` and ``at`` (squared distance and its round, per vector and centroid)
    are brought up to date in place wherever a distance is evaluated."""
    now, k = len(history) - 1, history.shape[1]
    moved, each = displacements(history), np.arange(len(v))
    loosened = moved[np.arange(k)[None], at]
    low = np.sqrt(seen) - loosened
    up = np.sqrt(seen[each, cluster]) + loosened[each, cluster]
    low[each, cluster] = np.inf
    open_rows = np.flatnonzero(low.min(axis=1) <= up * (1 + _SAFE) + _SAFE)
    out, took = cluster.copy(), 0

    own = squared(v[open_rows], history[-1][cluster[open_rows]])
    seen[open_rows, cluster[open_rows]], at[open_rows, cluster[open_rows]] = own, now
    took += len(open_rows)
    best, reach = own.copy(), np.sqrt(own) * (1 + _SAFE) + _SAFE
    for j in range(k):
        near = np.flatnonzero(low[open_rows, j] <= reach)
        rows = open_rows[near]
        found = squared(v[rows], history[-1][j])
        seen[rows, j], at[rows, j] = found, now
        took += len(rows)
        closer = (found < best[near]) | ((found == best[near]) & (j < out[rows]))
        out[rows[closer]], best[near[closer]] = j, found[closer]
    return out, took


def first_state(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """All distances to the first centroids."""
    dims = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), dims)
            if v.size and (v.max() >= MOST_COMPONENT or v.min() < -MOST_COMPONENT):
                raise ValueError(f"scaled components must be below {MOST_COMPONENT}")
            seen = np.stack([squared(v, c) for c in centroids], axis=1)
            yield _state(batch, seen.argmin(axis=1), np.full(len(v), -1), seen, np.zeros(seen.shape, int))

    return rows.select("vec_id", "v").mapInArrow(assign, _STATE)


def next_state(state: DataFrame, history: np.ndarray, exact: bool = False) -> DataFrame:
    """The state after one more assignment; ``exact`` brings every own distance up to date."""
    k, dims = history.shape[1:]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, was = matrix(batch.column("v"), dims), batch.column("cluster").to_numpy()
            seen, at = matrix(batch.column("seen"), k).copy(), matrix(batch.column("at"), k).copy()
            cluster, _ = reassign(v, was, seen, at, history)
            if exact:
                seen[np.arange(len(v)), cluster] = squared(v, history[-1][cluster])
            yield _state(batch, cluster, was, seen, at)

    return state.mapInArrow(assign, _STATE)


def _state(batch, cluster, was, seen, at) -> pa.RecordBatch:
    starts = pa.array(np.arange(0, seen.size + 1, seen.shape[1], dtype=np.int32))
    lists = lambda x, kind: pa.ListArray.from_arrays(starts, pa.array(x.astype(kind).ravel()))
    small = lambda x: pa.array(x.astype(np.int32))
    columns = [batch.column("vec_id"), batch.column("v"), small(cluster), small(was)]
    return pa.RecordBatch.from_arrays(
        [*columns, lists(seen, np.int64), lists(at, np.int32)], ["vec_id", "v", "cluster", "was", "seen", "at"]
    )


def moved_sums(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed their centroid add to its sum and count."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            v = matrix(batch.column("v"), dims)
            v = np.concatenate([v, np.ones((len(v), 1), np.int64)], axis=1)
            cluster, was = batch.column("cluster").to_numpy(), batch.column("was").to_numpy()
            for j in range(k):
                sums[j] += v[cluster == j].sum(axis=0) - v[was == j].sum(axis=0)
        at = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel()[at])], ["place", "total"])

    found = (
        state.where("cluster <> was")
        .select("v", "cluster", "was")
        .mapInArrow(add, "place long, total long")
        .groupBy("place")
        .agg(F.sum("total").alias("total"))
    )
    sums = np.zeros(k * (dims + 1), np.int64)
    for place, total in found.collect():
        sums[place] = total
    sums = sums.reshape(k, dims + 1)
    return sums[:, :dims], sums[:, dims]


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest digests of their ids."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    picked = rows.where("vec_id is not null").orderBy(order, "vec_id", "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in picked], np.int64)


def cluster_vectors(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``v``, ``cluster`` and the squared ``distance`` of every whole
    vector, and the final centroids."""
    ship(vectors.sparkSession)
    rows = whole_vectors(vectors, scale, dims).select("vec_id", "v")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.limit(0).selectExpr("vec_id", "v", "0 as cluster", "0L as distance"), centroids.reshape(0, dims)
    history, k = centroids[None], len(centroids)
    state = spool(first_state(rows, centroids))
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    for turn in range(rounds):
        more, came = moved_sums(state, k, dims)
        sums, counts = sums + more, counts + came
        filled = (counts > 0)[:, None]
        centroids = np.where(filled, sums // np.maximum(counts, 1)[:, None], history[-1])
        history = np.concatenate([history, centroids[None]])
        later = spool(next_state(state, history, exact=turn == rounds - 1))
        discard(state)
        state = later
    found = state.select("vec_id", "v", "cluster", F.get("seen", F.col("cluster")).alias("distance"))
    return found, history[-1]


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """Every vector with its cluster, distance, the sums of distances over its cluster
    and over all, and the digest of its centroid."""
    found, centroids = cluster_vectors(vectors, **options)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = dict(found.groupBy("cluster").agg(total.cast("long")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(j, inertia[j], sum(inertia.values()), digests[j]) for j in sorted(inertia)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    facts = F.broadcast(vectors.sparkSession.createDataFrame(facts, schema))
    return found.select("vec_id", "cluster", "distance").join(facts, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
