"""The two classifiers: held-out accuracy, and what they must not look at."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hoptrail.llm import quality_model, queries, toxicity

from . import cases

FOLDER = "/root/testdata/sf0.01"


def judged(spark, query, label):
    out = query(spark, FOLDER).join(cases.read(spark, FOLDER, "labels"), "doc_id").toPandas()
    return out, out[out.held_out], label


def test_quality_on_held_out_documents(spark):
    out, held, label = judged(spark, queries.op7_quality_model, "quality")
    assert list(out.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]
    assert (out.predicted == (out.score >= 0.5)).all()
    assert (held.predicted == held[label]).mean() >= 0.9
    assert held[held[label] == 1].predicted.mean() >= 0.97


def test_toxicity_on_held_out_documents(spark):
    out, held, label = judged(spark, queries.op8_toxicity, "toxic")
    assert list(out.held_out) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]
    assert (out.predicted == (out.score >= 0.3)).all()
    assert (held.predicted == held[label]).mean() >= 0.9
    assert held[held[label] == 0].predicted.mean() <= 0.05


def test_held_out_labels_are_not_learnt(spark):
    docs = cases.read(spark, "/root/testdata/sf0.001", "documents")
    labels = cases.read(spark, "/root/testdata/sf0.001", "labels")
    for operator, name, divisor, out in (
        (quality_model.score_quality, "quality", 3, 1),
        (toxicity.score_toxicity, "toxic", 4, 2),
    ):
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == out
        turned = labels.withColumn(name, F.when(held, 1 - F.col(name)).otherwise(F.col(name)))
        same = [sorted(map(tuple, operator(docs, x).collect())) for x in (labels, turned)]
        assert same[0] == same[1]


def test_machine_learns_a_pair_that_weights_cannot_tell():
    """Toxic only where both terms meet: each of them alone says little."""
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(3000):
        one, other = rng.random(2) < 0.3
        rows.append(np.array([5] * int(one) + [9] * int(other) + list(rng.integers(20, 40, 4)), np.int64))
        y.append(float(one and other))
    rows, y = [np.unique(r) for r in rows], np.array(y)
    machine = toxicity.fit(rows, y, 64)
    raw, _ = machine.raw(np.array([0, 1, 2, 2]), np.array([5, 9, 5, 9]), 3)
    score = quality_model.probability(raw)
    assert score[2] > 0.8 and max(score[:2]) < 0.3
    weights = machine.weights
    assert abs(raw[2] - (machine.bias + weights[5] + weights[9])) > 0.5


def test_machine_learns_a_term_that_tells_only_beside_another():
    """Term 9 is as frequent in toxic texts as in all, but decides beside term 5."""
    rng = np.random.default_rng(4)
    chance = {(1, 1): 0.9, (1, 0): 0.3, (0, 1): 0.0, (0, 0): 0.25}
    rows, y = [], []
    for _ in range(4000):
        one, other = (int(x) for x in rng.random(2) < 0.3)
        rows.append(np.unique(np.array([5] * one + [9] * other + list(rng.integers(20, 40, 4)), np.int64)))
        y.append(float(rng.random() < chance[one, other]))
    y = np.array(y)
    telling = toxicity.telling_terms(rows, y, y.mean(), 64)
    assert telling[5] and not telling[9]
    machine = toxicity.fit(rows, y, 64)
    raw, _ = machine.raw(np.array([0, 1, 2, 2]), np.array([5, 9, 5, 9]), 3)
    score = quality_model.probability(raw)
    assert score[2] > 0.7 and score[0] < 0.5 and score[1] < 0.3


def test_pair_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(0.3, rng.normal(size=32), rng.normal(size=(32, 3)))
    found = np.array([1, 4, 7, 30])
    raw, _ = machine.raw(np.zeros(4, np.int64), found, 1)
    pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(found) for b in found[:i])
    assert raw[0] == pytest.approx(0.3 + machine.weights[found].sum() + pairs)


def test_leader_follows_the_closed_form():
    """After any updates the weights minimise the linearised loss plus penalties."""
    leader, rng = quality_model.Leader(3), np.random.default_rng(3)
    at, z, n = np.arange(3), np.zeros(3), np.zeros(3)
    for _ in range(20):
        g, w = rng.normal(size=3), leader.weights(at)
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / quality_model.ALPHA * w
        n += g * g
        leader.update(at, g)
    pull = (quality_model.BETA + np.sqrt(n)) / quality_model.ALPHA + quality_model.L2
    expected = np.where(np.abs(z) <= quality_model.L1, 0, -(z - np.sign(z) * quality_model.L1) / pull)
    assert leader.weights(at) == pytest.approx(expected)


def test_edges(spark):
    docs = cases.edge_documents(spark)
    marks = [(1, 1, 1), (1, 0, 0), (4, None, None), (None, 1, 1), (6, 7, 7)]
    for labels in (cases.labels(spark), cases.labels(spark, marks)):
        for operator in (quality_model.score_quality, toxicity.score_toxicity):
            rows = operator(docs, labels).collect()
            assert len(rows) == len(cases.EDGES)
            assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
            empties = {round(r["score"], 12) for r in rows if r["doc_id"] in (3, 4, 5)}
            assert len(empties) == 1
            assert operator(cases.empty_documents(spark), labels).count() == 0
    assert {r["score"] for r in quality_model.score_quality(docs, cases.labels(spark)).collect()} == {0.5}
