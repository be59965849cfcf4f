from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from hoptrail.llm import arrays, components, near_dedup, queries

from . import cases


def brute(rows, words, percent=80):
    """All links by comparing all pairs of sets, and the components they make."""
    sets = {i: near_dedup.shingle_set(t or "", words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(found, expected):
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())


def test_all_documents(spark, small):
    found = cases.by_id(queries.op6_near_dedup(spark, small))
    check(found, brute(cases.texts(spark, small), 2))


def chain(n, seed):
    """Texts that drift, so that neighbours are alike and ends are not."""
    rng, text, out = random.Random(seed), [f"w{i}" for i in range(60)], []
    for i in range(n):
        out.append((i * 3 + seed * 1000, " ".join(text)))
        text[rng.randrange(60)] = f"x{seed}{i}"
    return out


def test_chains_are_one_component(spark):
    rows = chain(60, 1) + chain(40, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(cases.by_id(near_dedup.near_duplicates(docs, words=2)), brute(rows, 2))
    check(cases.by_id(near_dedup.near_duplicates(docs, words=5)), brute(rows, 5))


def test_edges(spark):
    docs = cases.edge_documents(spark)
    rows = near_dedup.near_duplicates(docs, words=5).collect()
    assert len(rows) == len(cases.EDGES)
    found = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    check(found, brute([(e[0], e[1]) for e in cases.EDGES if e[0] is not None], 5))
    lost = [r for r in rows if r["doc_id"] is None]
    assert len(lost) == 1 and lost[0]["kept"] and lost[0]["component_id"] is None
    assert near_dedup.near_duplicates(cases.empty_documents(spark)).count() == 0


def test_sketches_do_not_depend_on_pieces_and_merge():
    rows = [t for _, t in chain(20, 3)] + ["", "one", "one two three"]

    def registers(texts, most):
        out = []
        for piece in arrays.pieces(pa.array(texts), most):
            found, owner = near_dedup.shingle_hashes(piece, 2)
            out.append(near_dedup.truncate(near_dedup.smallest_points(found, owner, len(piece))))
        return np.concatenate(out)

    whole = registers(rows, 1 << 30)
    assert (whole == registers(rows, 1)).all()
    a, b = "q1 q2 q3 q4 q5", "q5 q6 q7 q8"
    sides, joined = registers([a, b], 1 << 30), registers(["q1 q2 q3 q4 q5 q6 q7 q8"], 1 << 30)
    assert (sides.max(axis=0) == joined[0]).all()


def test_likelihood_estimate():
    rng = np.random.default_rng(5)
    for similarity in (0.2, 0.5, 0.8, 0.95):
        shared = int(1000 * similarity)
        ids = rng.integers(0, 1 << 62, 2000 - shared).astype(np.uint64)
        one, other = ids[:1000], ids[1000 - shared :]
        both = np.concatenate([one, other])
        owner = np.repeat([0, 1], [len(one), len(other)])
        rows = near_dedup.truncate(near_dedup.smallest_points(both, owner, 2))
        true = shared / (2000 - shared)
        found = near_dedup.likely_similarity(rows[:1], rows[1:], np.array([len(one)]), np.array([len(other)]))
        assert abs(found[0] - true) < near_dedup.MARGIN


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 160) for i in range(30)] + [(7, 7), (300, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(df).collect()}
    expected = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {160: 100, 200: 200, 300: 200}
    assert found == expected
    assert components.components(df.limit(0)).count() == 0


def test_links_that_are_stars_need_no_round_and_a_round_is_written_once(spark, monkeypatch):
    written = []
    spool = components.spool
    monkeypatch.setattr(components, "spool", lambda df, **options: written.append(1) or spool(df, **options))
    links = spark.createDataFrame([(100, 100 + i) for i in range(1, 40)] + [(700, 650)], "a long, b long")
    found = components.components(links)
    expected = {100 + i: 100 for i in range(40)} | {650: 650, 700: 650}
    assert {r["node"]: r["component"] for r in found.collect()} == expected
    assert len(written) == 1
    more = spark.createDataFrame([(139, 700), (650, 20)], "a long, b long")
    found = components.components(components.stars(links).toDF("a", "b").union(more))
    assert {r["node"]: r["component"] for r in found.collect()} == {i: 20 for i in expected} | {20: 20}
    assert len(written) <= 6


def copies(groups, size, seed):
    """Groups of near copies, each with words of its own in a common text."""
    rng, out = random.Random(seed), []
    for group in range(groups):
        text = [f"g{group}w{i}" for i in range(80)]
        for i in range(size):
            own = text[:]
            for at in rng.sample(range(80), 3):
                own[at] = f"o{group}x{i}x{at}"
            out.append((group * 10_000 + i * 7, " ".join(own)))
    return out


def test_a_large_group_of_near_copies_writes_few_tables(spark, monkeypatch):
    rows = copies(1, 150, 4) + copies(3, 2, 5)[2:] + chain(12, 90) + [(500_000 + i, "the same few words " * 9) for i in range(60)]
    written = []
    for module in (components, near_dedup):
        spool = module.spool
        monkeypatch.setattr(module, "spool", lambda df, spool=spool, **options: written.append(1) or spool(df, **options))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(cases.by_id(near_dedup.near_duplicates(docs, words=2)), brute(rows, 2))
    assert len(written) <= 30
