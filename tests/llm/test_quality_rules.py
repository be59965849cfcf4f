from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from hoptrail.llm import arrays, queries, quality_rules

from . import cases


def base(text: str) -> tuple:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def tokens(text: str) -> list[str]:
    low = "".join(c.lower() if c.isascii() else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D!-/:-@\[-^`{-\x7f]+|[!-/:-@\[-^`{-\x7f]+", low)


@pytest.fixture(scope="module")
def judged(spark, small):
    return cases.by_id(queries.op1_quality_rules(spark, small))


def test_base_counts(spark, small, judged):
    for doc_id, text in cases.texts(spark, small):
        row, expected = judged[doc_id], base(text)
        assert tuple(row[n] for n in NAMES) == expected, doc_id
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert row["base_failed"] == failed
        assert row["kept"] == (not failed and row["score"] >= quality_rules.LEAST_SCORE)


def test_score_is_the_mean_log_ratio(spark, small, judged):
    """The same score without numpy: counts of n-grams by their bucket."""
    good = {r[0] for r in cases.read(spark, small, "labels").where("quality = 1").select("doc_id").collect()}
    raw, target, grams = Counter(), Counter(), {}
    for doc_id, text in cases.texts(spark, small):
        words = tokens(text)
        grams[doc_id] = words + list(zip(words, words[1:]))
        raw.update(grams[doc_id])
        if doc_id in good:
            target.update(grams[doc_id])
    share, prior = sum(target.values()) / sum(raw.values()), quality_rules.PRIOR
    ratio = {g: math.log((target[g] + prior) / (raw[g] * share + prior)) for g in raw}
    apart = [
        abs(judged[i]["score"] - (sum(ratio[g] for g in gs) / max(1, len(gs)))) for i, gs in grams.items()
    ]
    # Buckets are shared by chance, exact scores are not.
    assert np.mean(apart) < 0.02
    assert np.quantile(apart, 0.99) < 0.08


def test_labelled_quality_is_told_apart(spark, small, judged):
    marks = cases.read(spark, small, "labels").collect()
    good = [judged[r["doc_id"]]["score"] for r in marks if r["quality"] == 1 and not judged[r["doc_id"]]["base_failed"]]
    bad = [judged[r["doc_id"]]["score"] for r in marks if r["quality"] == 0 and not judged[r["doc_id"]]["base_failed"]]
    assert min(good) >= quality_rules.LEAST_SCORE
    assert max(bad, default=-9) < quality_rules.LEAST_SCORE


def test_edges(spark):
    docs = cases.edge_documents(spark)
    out = quality_rules.quality_rules(docs, cases.labels(spark, [(1, 1, 0), (1, 1, 0), (99, 1, 0)]))
    rows = out.collect()
    assert len(rows) == len(cases.EDGES)
    for row in rows:
        text = next(e[1] for e in cases.EDGES if e[0] == row["doc_id"])
        assert tuple(row[n] for n in NAMES) == base(text or "")
    assert all(r["score"] == 0 and not r["kept"] for r in rows if r["doc_id"] in (3, 4, 5))
    assert all(r["score"] == 0 for r in quality_rules.quality_rules(docs, cases.labels(spark)).collect())
    assert quality_rules.quality_rules(cases.empty_documents(spark), cases.labels(spark)).count() == 0


def test_counts_do_not_depend_on_pieces(spark, monkeypatch):
    texts = [e[1] or "" for e in cases.EDGES]
    import pyarrow as pa

    def counts(most):
        out = []
        for piece in arrays.pieces(pa.array(texts), most):
            base_counts = quality_rules.base_counts(piece)
            out += list(zip(*(base_counts[n].tolist() for n in NAMES)))
        return out

    assert counts(1) == counts(1 << 30) == [base(t) for t in texts]
