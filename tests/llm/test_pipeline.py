from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from hoptrail.llm import bpe, quality_rules, queries
from hoptrail.llm.spool import spool

from . import cases
from .test_decontaminate import brute as leaks
from .test_near_dedup import brute as copies
from .test_personal_data import base

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def redacted(text):
    out, at = "", 0
    for kind, start, end in sorted(base(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_stages(spark, small):
    """Each stage against a plain reading, on what the stages before it kept."""
    with open(public_tokenizers.path(queries.RANK_FILE), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = cases.read(spark, small, "documents")
    texts = dict(cases.texts(spark, small))
    items = [tuple(r) for r in cases.read(spark, small, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = texts
        docs = spool(stage(spark, docs, small))
        if name != "byte_bpe":
            assert docs.columns == COLUMNS
            texts = dict(docs.select("doc_id", "text").collect())
        if name == "quality_rules":
            judged = cases.by_id(queries.op1_quality_rules(spark, small))
            assert set(texts) == {i for i in before if judged[i]["kept"]}
        elif name == "near_duplicates":
            assert set(texts) == {i for i, (_, c) in copies(before.items(), 5).items() if i == c}
        elif name == "decontamination":
            assert set(texts) == set(before) - {i for i, _ in leaks(before.items(), items)}
        elif name == "personal_data":
            assert set(texts) == set(before)
            assert all(texts[i] == redacted(t) for i, t in before.items())
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
        if name not in ("personal_data", "byte_bpe"):
            assert all(texts[i] == before[i] for i in texts)
    rows = cases.by_id(docs)
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        assert rows[doc_id]["ids"] == theirs.encode_ordinary(text)
        assert rows[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "personal_data", "byte_bpe",
    ]


def test_edges(spark, tmp_path):
    good = [(10 + i, f"good text {i} " + " ".join(f"{w}{i}" for w in range(1000, 1080)), "s", 1)
            for i in range(3)]
    docs = spark.createDataFrame(cases.EDGES + good, cases.SCHEMA)
    labels = cases.labels(spark, [(10, 1, 0), (11, 1, 0)])
    bench = spark.createDataFrame([(1, "nothing of the kind is in here")], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    for source in (docs, docs.limit(0)):
        kept = source
        for name, stage in corpus_pipeline.STAGES:
            kept = spool(stage(spark, kept, str(tmp_path)))
            if name != "byte_bpe":
                assert set(kept.columns) >= {"doc_id", "text", "score", "kept"}
        expected = {10, 11, 12} if source is docs else set()
        assert {r["doc_id"] for r in kept.collect()} == expected
    assert Counter(quality_rules.SYMBOLS) and corpus_pipeline.run(spark, str(tmp_path)).count() == 3
