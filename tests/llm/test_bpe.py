from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hoptrail.llm import bpe, queries

from . import cases

FILE = public_tokenizers.path(queries.RANK_FILE)


@pytest.fixture(scope="module")
def own():
    with open(FILE, "rb") as file:
        return bpe.Tokenizer(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs(own):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={}
    )


def row(text: str, theirs) -> tuple:
    ids = theirs.encode_ordinary(text)
    return (
        len(ids),
        hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )


def test_all_documents(spark, small, theirs):
    found = cases.by_id(queries.op5_byte_bpe(spark, small))
    for doc_id, text in cases.texts(spark, small):
        assert tuple(found[doc_id])[1:] == row(text, theirs)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("aabeithths \n\t1!-'é漢😀²\u00a0\x1c"), max_size=80))
def test_any_text(text, own, theirs):
    ids = own.encode(text)
    assert ids == theirs.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_long_pre_tokens(own, theirs):
    for text in ("ab" * 20000, "a" * 20001, "xyzzy" * 9999):
        assert own.encode(text) == theirs.encode_ordinary(text)


def test_short_pre_tokens_are_merged_as_long_ones(own, theirs):
    merger = bpe.Merger(own.ranks)
    words = ["thonerthing"[i % 7 :] * (1 + i % 9) + "éàxq"[i % 4] * (i % 5) for i in range(400)] + ["a", "aa" * 20, "é漢"]
    for word in words:
        data = word.encode()
        assert merger.merge_short(data) == merger.merge_long(data)
        assert merger.merge(data) == theirs.encode_ordinary(word)


def test_edges(spark, theirs):
    docs = cases.edge_documents(spark)
    rows = bpe.encode_texts(docs, FILE, public_tokenizers.PATTERN, ["doc_id", "kept"], with_ids=True).collect()
    assert len(rows) == len(cases.EDGES)
    for r in rows:
        text = next(e[1] for e in cases.EDGES if e[0] == r["doc_id"]) or ""
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == row(text, theirs)
        assert r["ids"] == theirs.encode_ordinary(text)
    assert bpe.encode_texts(docs.limit(0), FILE, public_tokenizers.PATTERN, ["doc_id"]).count() == 0
