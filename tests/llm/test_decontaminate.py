from __future__ import annotations

import random
from collections import Counter, defaultdict

import regex

from hoptrail.llm import decontaminate, queries

from . import cases


def words(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def shingles(found):
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]


def brute(docs, items, least=0.8):
    """The best of all windows of every document for every item that shares a shingle."""
    held, where = {i: words(t) for i, t in items}, defaultdict(set)
    for i, w in held.items():
        for s in shingles(w):
            where[s].add(i)
    out = {}
    for doc_id, text in docs:
        w = words(text)
        for i in {i for s in shingles(w) for i in where.get(s, ())}:
            size, own = len(held[i]), Counter(shingles(held[i]))
            best = max(
                (sum((c & own).values()) / sum((c | own).values()), -k)
                for k in range(max(1, len(w) - size + 1))
                for c in [Counter(shingles(w[k : k + size]))]
            )
            if best[0] >= least:
                out[doc_id, i] = (best[0], -best[1])
    return out


def found(df):
    return {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"]) for r in df.collect()}


def test_all_documents(spark, small):
    items = [tuple(r) for r in cases.read(spark, small, "benchmark").select("item_id", "text").collect()]
    expected = brute(cases.texts(spark, small), items)
    assert expected
    assert found(queries.op3_benchmark_windows(spark, small)) == expected


def test_changed_passages_and_edges(spark):
    item = " ".join(f"w{i}" for i in range(60))
    changed = item.split()
    changed[20] = "other"
    shorter = [w for i, w in enumerate(item.split()) if i not in (30,)]
    rows = [
        (1, "before " * 9 + item + " after" * 9),
        (2, "x y " + " ".join(changed).upper() + "! z"),
        (3, "start " + " ".join(shorter) + " end end end"),
        (4, " ".join(item.split()[:30]) + " and nothing else of it"),
        (5, None),
        (6, ""),
        (7, "few words"),
        (None, item),
        (8, item),
        (8, item),
        (9, "again " * 3 + item + " " + item),
    ]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, similarity double")
    items = [(1, item), (1, item), (2, "too short"), (3, None), (None, item), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute([r for r in rows if r[0] is not None], [(1, item)])
    assert {k[0] for k in expected} == {1, 2, 3, 8, 9}
    got = found(decontaminate.contaminated(docs, bench))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    for (doc_id, _), (similarity, first) in got.items():
        window = words(dict(r[:2] for r in rows)[doc_id])[first : first + 60]
        assert brute([(doc_id, " ".join(window))], [(1, item)])[doc_id, 1][0] == similarity
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    """Pairs at each distance up to the radius meet in a block; few beyond it do."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        mark, far = rng.getrandbits(64), i % 24
        other = mark
        for bit in rng.sample(range(64), far):
            other ^= 1 << bit
        signed = [x - (1 << 64) if x >> 63 else x for x in (mark, other)]
        rows.append((i, *signed, far))
    df = spark.createDataFrame(rows, "item_id int, item_mark long, mark long, far int")
    items = decontaminate._near_blocks(df.selectExpr("item_id", decontaminate._blocks("item_mark")), decontaminate.RADIUS)
    windows = df.selectExpr("item_id as own", "far", decontaminate._blocks("mark"))
    met = windows.join(items, ["block", "value"]).select("own", "item_id", "far").distinct().collect()
    assert {i for i, _, _, far in rows if far <= decontaminate.RADIUS} <= {r["own"] for r in met if r["own"] == r["item_id"]}
    assert sum(r["own"] != r["item_id"] for r in met) < 0.06 * 400 * 400


def test_a_very_long_text(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    item = [word() for _ in range(40)]
    text = [word() for _ in range(30_000)]
    for at in (0, 9_000, 29_960):
        text[at : at + 40] = item
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(text[40:8_000]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"], r["first_word"]) for r in found] == [(1, 7, 1.0, 0)]
