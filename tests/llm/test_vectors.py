"""Centroids and hard negatives against plain readings, and the filters by themselves."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from check_oracle import database, difference
from hoptrail.llm import centroids, hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, rank string, v string"
NAN, INF = float("nan"), float("inf")


def edge_vectors(dims=64):
    """Nulls, odd lengths, ties, repeated rows and columns named like results."""
    rng = np.random.default_rng(7)
    point = lambda: [float(x) for x in rng.normal(size=dims)]
    shared, rows = point(), []
    rows += [(i, point(), i % 3) for i in range(0, 120)]
    rows += [(200 + i, shared, i % 2) for i in range(40)]
    rows += [(150, point(), 1)] * 2 + [(None, point(), 1), (300, None, 1), (301, point(), None), (None, None, None)]
    rows += [(302, [NAN] + point()[1:], 0), (303, [INF] + point()[1:], 0), (304, [None] + point()[1:], 0)]
    rows += [(350, [0.0] * dims, 2), (351, [0.0] * dims, 1), (352, [], 0), (400, [], 1), (353, point()[:5], 0)]
    return [(*r, "x", None, "y") for r in rows]


def plain_clusters(rows, k=8, rounds=10):
    whole = lambda e: e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)
    kept = [(i, np.array([math.floor(1024 * float(np.float32(x))) for x in e], object)) for i, e, *_ in rows if whole(e)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), list(v)) for i, v in kept if i is not None)
    now = [np.array(v, object) for _, v in named[:k]]
    near = lambda v: min((int(((v - c) ** 2).sum()), j) for j, c in enumerate(now))
    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in kept:
            held[near(v)[1]].append(v)
        now = [sum(held[j]) // len(held[j]) if held[j] else c for j, c in enumerate(now)]
    found = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    sums = defaultdict(int)
    for _, j, d in found:
        sums[j] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(((i, j, d, sums[j], sum(sums.values()), digests[j]) for i, j, d in found), key=repr)


def plain_negatives(rows):
    kept = []
    for n, (i, e, label, *_) in enumerate(rows):
        if None not in (i, e, label) and all(x is not None and math.isfinite(x) for x in e):
            kept.append((n, i, label, [math.floor(256 * float(np.float32(x))) for x in e]))
    out = []
    for n, i, label, v in kept:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m, other) for m, j, other, w in kept if m != n)
        for ps, j, *_ in [s for s in scored if s[3] == label][:5]:
            fits = [s for s in scored if s[3] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(i, j, r, s[1], -ps, -s[0]) for r, s in enumerate(fits[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("name", ["op11_centroids", "op12_hard_negatives"])
def test_same_rows_as_sql(spark, small, name):
    found = queries.QUERIES[name](spark, small).toArrow()
    assert found.num_rows
    assert difference(found, database(small), queries.ORACLE_SQL[name]) == ""


def test_clusters_of_edges(spark):
    rows = edge_vectors()
    found = centroids.cluster_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, found), key=repr) == plain_clusters(rows)


def test_fewer_vectors_than_centroids(spark):
    rows = edge_vectors()[:3]
    found = centroids.cluster_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == plain_clusters(rows)
    assert {r["distance"] for r in found} == {0}
    for none in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1.0], 1, "", "", "")], SCHEMA)):
        assert centroids.cluster_report(none).collect() == []


def test_too_large_components_are_told(spark):
    rows = [(1, [2.0**40] * 64, 1, "", "", "")]
    with pytest.raises(Exception, match="scaled components"):
        centroids.cluster_report(spark.createDataFrame(rows, SCHEMA)).collect()


@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_bounds_give_the_nearest_with_fewer_distances(spread):
    rng = np.random.default_rng(int(spread * 10))
    middles = rng.integers(-900, 900, (8, 16))
    v = middles[rng.integers(0, 8, 3000)] + (rng.normal(size=(3000, 16)) * 100 * spread).astype(np.int64)
    now = v[:8].copy()
    history = now[None]
    full = lambda c: ((v[:, None] - c[None]) ** 2).sum(axis=2)
    seen, at = full(now), np.zeros((3000, 8), np.int64)
    cluster, total = seen.argmin(axis=1), 0
    for _ in range(12):
        now = np.array([v[cluster == j].sum(axis=0) // max(1, (cluster == j).sum()) for j in range(8)])
        history = np.concatenate([history, now[None]])
        cluster, took = centroids.reassign(v, cluster, seen, at, history)
        total += took
        assert (cluster == full(now).argmin(axis=1)).all()
    assert total < 0.6 * 12 * 3000 * 8
    # A bound loosened by the whole displacement is never looser than by the sum of steps.
    steps = np.sqrt((np.diff(history, axis=0).astype(float) ** 2).sum(axis=2))
    assert (centroids.displacements(history)[:, 0] <= steps.sum(axis=0) + 1e-6).all()


def test_ties_go_to_the_smaller_centroid():
    history = np.array([[[0, 0], [10, 0]], [[0, 0], [10, 0]]])
    v = np.array([[5, 0], [5, 7], [6, 0]])
    seen = np.stack([centroids.squared(v, c) for c in history[0]], axis=1)
    found, _ = centroids.reassign(v, np.array([1, 1, 0]), seen, np.zeros((3, 2), int), history)
    assert list(found) == [0, 0, 1]


@pytest.mark.parametrize("slice_rows", [16_384, 2])
def test_negatives_of_edges(spark, slice_rows):
    rows = edge_vectors(dims=6)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hard_negatives.mine_negatives(vectors, slice_rows=slice_rows).collect()
    assert found and sorted(map(tuple, found)) == plain_negatives(rows)


def test_negatives_of_large_numbers(spark):
    rows = [(i, [x * 2.0**20 for x in e], label, *more) for i, e, label, *more in edge_vectors(dims=3) if e and None not in e]
    found = hard_negatives.mine_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(r["positive_score"] for r in found) > 2**52
    assert sorted(map(tuple, found)) == plain_negatives(rows)


def test_no_anchors_no_rows(spark):
    for rows in ([], edge_vectors(4)[1:3], [(0, [1.0], 1, "", "", "")], [(50, [], 1, "", "", ""), (51, [], 2, "", "", "")]):
        assert hard_negatives.mine_negatives(spark.createDataFrame(rows, SCHEMA)).collect() == []


def _rows(rng, n, references, norms):
    v = (rng.normal(size=(n, 12)) * norms + rng.normal(size=12) * norms).astype(np.int64)
    norm = np.sqrt((v * v).sum(axis=1).astype(float))
    angles = hard_negatives.angles_to(v.astype(float), norm, references)
    return hard_negatives.Rows(np.arange(n), np.arange(n), np.zeros(n, int), v, norm, angles)


@pytest.mark.parametrize("norms", [0.4, 5, 3000])
def test_intervals_hold_all_scores(norms):
    rng = np.random.default_rng(3)
    references = rng.normal(size=(5, 12))
    references /= np.sqrt((references**2).sum(axis=1))[:, None]
    tight = 0
    for _ in range(40):
        anchors, window = (_rows(rng, n, references, norms) for n in (30, 8))
        scores = anchors.v @ window.v.T
        low, high = hard_negatives.score_bounds(anchors, window)
        assert (low <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high).all()
        tight += (high < anchors.norm * window.norm.max()).sum()
    assert norms < 1 or tight > 300


def test_windows_out_of_reach_are_not_scored():
    rng = np.random.default_rng(5)
    references = np.eye(12)[:4]
    clusters = [np.eye(12)[i] * 1000 for i in range(4)]
    v = np.concatenate([c + rng.normal(size=(600, 12)) * 20 for c in clusters]).astype(np.int64)
    norm = np.sqrt((v * v).sum(axis=1).astype(float))
    rows = hard_negatives.Rows(
        np.arange(2400), np.arange(2400), np.zeros(2400, int), v, norm, hard_negatives.angles_to(v.astype(float), norm, references)
    )
    anchors, best = rows.take(np.arange(0, 2400, 100)), hard_negatives.Best(24, 1, 5, None)
    for window in rows.windows():
        hard_negatives.best_positives(window, anchors, best)
    again = hard_negatives.Best(24, 1, 5, best.need())
    scored = sum(hard_negatives.best_positives(w, anchors, again) for w in rows.windows())
    assert scored < 0.5 * 24 * 2400
    expected = np.sort(np.where(np.arange(2400) == anchors.row[:, None], -(1 << 60), anchors.v @ v.T), axis=1)[:, :-6:-1]
    assert (best.score[:, 0] == expected).all() and (again.score == best.score).all()


def test_shorter_lists_are_padded():
    lists = pa.array([[1, 2, 3], [], [4]], pa.list_(pa.int64()))
    assert hard_negatives.padded(lists, 3).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0]]
