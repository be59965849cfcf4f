"""The language network: gradients, a plain reading of its cells, held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hoptrail.llm import arrays, language_id, queries

from . import cases

FOLDER = "/root/testdata/sf0.01"


def network(languages=("aa", "bb", "cc"), size=5):
    made = language_id.Network.fresh(list(languages), size, seed=3)
    return language_id.Network(made.languages, [w.astype(float) for w in made.weights])


def squash(x):
    return x / (1 + abs(x))


def plain_states(reader, data):
    """One cell after the other, number by number."""
    n, state, out = reader.size, [0.0] * reader.size, []
    for byte in data:
        held = [sum(state[i] * reader.recurrent[i][j] for i in range(n)) for j in range(3 * n)]
        given = reader.inputs[byte]
        z = [(1 + squash(given[j] + held[j])) / 2 for j in range(n)]
        r = [(1 + squash(given[n + j] + held[n + j])) / 2 for j in range(n)]
        new = [squash(given[2 * n + j] + r[j] * held[2 * n + j]) for j in range(n)]
        state = [z[j] * state[j] + (1 - z[j]) * new[j] for j in range(n)]
        out.append(state)
    return np.array(out).reshape(-1, n)


def plain_probabilities(net, text):
    data, found = text.encode(), []
    for first in range(0, len(data), language_id.SEGMENT):
        part = data[first : first + language_id.SEGMENT]
        both = np.concatenate([plain_states(net.forth, part), plain_states(net.back, part[::-1])[::-1]], axis=1)
        raw = np.exp(both @ net.weights[4] + net.weights[5])
        found += list(raw / raw.sum(axis=1)[:, None])
    return np.mean(found, axis=0) if found else np.zeros(len(net.languages))


def test_pooled_positions_of_whole_texts():
    net = network()
    texts = ["", "a", "x" * 128, "some words, é and 漢字 " * 20, "short", "y" * 300]
    piece = next(arrays.pieces(pa.array(texts)))
    found = language_id.probabilities(net, piece)
    assert found == pytest.approx(np.array([plain_probabilities(net, t) for t in texts]), abs=1e-5)


def test_gradients_against_differences():
    net, rng = network(), np.random.default_rng(4)
    codes, label = rng.integers(0, 256, (7, 6)), rng.integers(0, 3, 6)
    real = (np.arange(7)[:, None] < np.array([7, 7, 3, 1, 5, 7])[None]).astype(float)
    _, slopes = net.gradients(codes, real, label)
    for w, s in zip(net.weights, slopes):
        for at in np.argsort(-np.abs(s).ravel())[:3]:
            place, step = np.unravel_index(at, w.shape), 1e-5
            kept, losses = w[place], []
            for sign in (1, -1):
                w[place] = kept + sign * step
                losses.append(net.gradients(codes, real, label)[0])
            w[place] = kept
            # States are held in single precision.
            assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(s[place], rel=0.02, abs=2e-4)


def test_training_learns_what_needs_both_sides():
    """The label is decided by the first or the last byte, all else is noise."""
    rng = np.random.default_rng(5)
    codes = rng.integers(97, 123, (10, 1500))
    label = rng.integers(0, 2, 1500)
    end = rng.integers(0, 2, 1500)
    codes[np.where(end, 9, 0), np.arange(1500)] = 48 + label
    net = language_id.Network.fresh(["aa", "bb"], 8)
    losses = language_id.train(net, codes, np.ones((10, 1500), np.float32), label, passes=12)
    assert np.mean(losses[-10:]) < 0.1 < np.mean(losses[:10])


def test_segments_cover_every_byte_once():
    piece = next(arrays.pieces(pa.array(["", "a" * 128, "b" * 129, None, "é" * 200])))
    start, end, owner = language_id.segments(piece)
    assert list(np.bincount(owner, end - start, minlength=5)) == [0, 128, 129, 0, 400]
    assert (end - start <= language_id.SEGMENT).all() and (start[1:] == end[:-1]).all()


def test_held_out_documents(spark):
    out = queries.op13_language(spark, FOLDER).toPandas().set_index("doc_id").sort_index()
    docs = cases.read(spark, FOLDER, "documents").toPandas().set_index("doc_id").sort_index()
    assert list(out.index) == list(docs.index)
    assert list(out.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.index]
    read = docs.text.map(lambda t: any(c.isalpha() for c in t or ""))
    assert (out.lang_pred[~read] == "und").all() and set(out.lang_pred[read]) <= set(docs.lang)
    assert ((out.score >= 0) & (out.score <= 1)).all()
    held = read & out.held_out
    assert (out.lang_pred[held] == docs.lang[held]).mean() >= 0.98


def test_held_out_languages_are_not_learnt(spark):
    docs = cases.read(spark, "/root/testdata/sf0.001", "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("y"))
    same = [sorted(map(tuple, language_id.identify_language(d, 20).collect())) for d in (docs, turned)]
    assert same[0] == same[1]


def test_edges(spark):
    plain = cases.edge_documents(spark)
    rows = [(20, "123 !?", "x", 1), (21, "́", None, 1), (22, "ñ", None, None)]
    docs = plain.union(spark.createDataFrame(rows, cases.SCHEMA))
    none, both = F.lit(None).cast("string"), F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    for lang, learnt in ((none, {"und"}), (both, {"even", "odd"})):
        got = language_id.identify_language(docs.withColumn("lang", lang)).collect()
        assert len(got) == len(cases.EDGES) + 3
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (3, 4, 5, 20, 21))
        assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 6, 7, 8, 22, None)} <= learnt
        assert not any(r["held_out"] for r in got if r["doc_id"] is None)
        assert language_id.identify_language(cases.empty_documents(spark).withColumn("lang", lang)).count() == 0


def test_at_most_so_many_rows_and_repeats_once(spark):
    rows = [(i, f"text {i}", "aa" if i % 3 else "bb") for i in range(60)] + [(0, "text 0", "bb")] * 50 + [(0, "text 0", "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    picked = [tuple(r) for r in language_id.training_rows(docs, 5).select("lang", "doc_id").collect()]
    assert len(picked) == len(set(picked)) and {lang for lang, _ in picked} == {"aa", "bb", "cc"}
    assert sorted(lang for lang, _ in picked).count("aa") == 5
    assert all(zlib.crc32(str(i).encode()) % 3 != 1 for _, i in picked)
