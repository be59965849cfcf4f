"""Repeated strings and repeated chunks, against plain readings of the contract."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from hoptrail.llm import chunks, queries, repeats

from . import cases

SCHEMA = "doc_id long, text string"


def bare_strings(rows, length):
    """What is left of each text, with every string looked up in a set."""
    seen, out = set(), {}
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            if part in seen:
                gone[at : at + length] = True
            seen.add(part)
        out[doc_id] = summary(data, gone)
    return out


def summary(data, gone):
    left = bytes(np.frombuffer(data, np.uint8)[~gone])
    spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
    return len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()


def found(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_all_documents(spark, small):
    rows = cases.texts(spark, small)
    assert found(queries.op9_repeated_strings(spark, small)) == bare_strings(rows, repeats.LENGTH)


def patchwork(seed, texts=60):
    """Texts that share stretches of all lengths around the threshold, and periods."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 9)))
    stock = ["".join(word() for _ in range(40))[: rng.randint(90, 260)] for _ in range(6)]
    rows = []
    for i in range(texts):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            piece = rng.choice(stock)
            if kind < 0.5:
                start = rng.randint(0, len(piece) // 2)
                parts.append(piece[start : start + rng.randint(60, 220)])
            elif kind < 0.7:
                parts.append(rng.choice(["ab", "a", "xyz"]) * rng.randint(1, 120))
            else:
                parts.append("".join(word() for _ in range(rng.randint(1, 30))))
        rows.append((i * 7 % 61, "".join(parts)))
    return sorted(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_patchwork(spark, seed):
    rows = patchwork(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(repeats.remove_repeats(docs)) == bare_strings(rows, repeats.LENGTH)


def test_edges(spark):
    docs = cases.edge_documents(spark)
    for operator in (repeats.remove_repeats, chunks.dedup_chunks):
        rows = operator(docs).collect()
        assert len(rows) == len(cases.EDGES)
        whole = {e[0]: (e[1] or "").encode() for e in cases.EDGES}
        for r in rows:
            assert r["n_bytes"] == len(whole[r["doc_id"]])
            assert r["n_bytes"] - r["n_removed"] == len(r["kept"])
            assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (None, 3, 4, 5, 8))
        assert operator(cases.empty_documents(spark)).count() == 0
    # The later of two rows with other ids goes; rows with the same id do not remove each other.
    short = spark.createDataFrame([(1, "q" * 30 + "r" * 90), (1, "q" * 30 + "r" * 90), (2, "q" * 30 + "r" * 90)], SCHEMA)
    rows = sorted((r["doc_id"], r["n_removed"]) for r in repeats.remove_repeats(short).collect())
    assert rows == [(1, 0), (1, 0), (2, 120)]


def plain_chunks(data):
    gear = [int(x) for x in chunks._GEAR]
    state, last, out = 0, 0, []
    for i, byte in enumerate(data):
        state, end = ((state << 1) + gear[byte]) & 0xFFFFFFFF, i + 1
        marked = end >= chunks.WINDOW and end - last >= chunks.LEAST_CHUNK and not state >> (32 - chunks.MASK_BITS)
        if marked or end - last == chunks.MOST_CHUNK:
            out.append((last, end))
            last = end
    return out + [(last, len(data))] * (last < len(data))


def test_chunks_resist_insertions(spark):
    rng = random.Random(9)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(60))
    filler = lambda: " ".join(str(rng.random()) for _ in range(rng.randint(3, 30)))
    rows = [(i, filler() + passage + filler()) for i in range(12)] + [(100 + i, filler()) for i in range(8)]
    got = found(chunks.dedup_chunks(spark.createDataFrame(rows, SCHEMA)))
    assert got[0][1] == 0
    assert all(got[i][1] >= 100 for i in range(1, 12))
    assert all(got[100 + i][1] == 0 for i in range(8))


def test_every_repeated_chunk_goes(spark, small):
    seen, expected = set(), {}
    for doc_id, text in cases.texts(spark, small):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for a, b in plain_chunks(data):
            gone[a:b] = data[a:b] in seen
            seen.add(data[a:b])
        expected[doc_id] = summary(data, gone)
    assert found(queries.op4_chunk_dedup(spark, small)) == expected
    assert any(0 < e[1] < 100 for e in expected.values())


def test_short_copies_go(spark):
    rows = [(1, "A short text."), (2, "A short text."), (3, "Another one."), (4, "x"), (5, "x")]
    got = found(chunks.dedup_chunks(spark.createDataFrame(rows, SCHEMA)))
    assert {i: got[i][1] for i in got} == {1: 0, 2: 13, 3: 0, 4: 0, 5: 1}
