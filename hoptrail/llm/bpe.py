"""Byte-level BPE encoding and decoding with a rank queue over hierarchical bitmaps.

The bytes of a pre-token form a linked list. Each neighbouring pair with a known
rank waits in the bucket of that rank under its position. Three levels of 64-bit
words mark the buckets in use, so a find-first-set per level gives the lowest rank
in constant time. A popped entry whose pair has changed since is stale and skipped.
A merge costs O(log n) at most, for the order of positions within a bucket, which
keeps pre-tokens of any length cheap. Short ones, which are nearly all, do without the
queue: the lowest rank of so few pairs is sooner found by looking at all of them.

Pre-tokens repeat, so a worker keeps the ids of those it has seen, up to a bound.

Defined cases: null and empty texts have no tokens; repeated rows are each encoded;
white space and control characters are encoded like anything else. Work is per row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.workers import held, ship

MOST_KNOWN = 400_000
MOST_KNOWN_BYTES = 64
BATCH_ROWS = 64
SHORT_BYTES = 40

_NO_RANK = 1 << 62
_BITS = [1 << i for i in range(64)]


class Merger:
    """Merges pre-tokens by rank. The queue is empty again after each of them, so
    its words and buckets are made once. A bucket holds one position or a heap."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.bucket: list = [None] * size
        self.low = [0] * (size // 64 + 1)
        self.middle = [0] * (size // 4096 + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        held = self.bucket[rank]
        if held is None:
            self.bucket[rank] = position
            a = rank >> 6
            b = a >> 6
            word = self.low[a]
            self.low[a] = word | _BITS[rank & 63]
            if not word:
                word = self.middle[b]
                self.middle[b] = word | _BITS[a & 63]
                if not word:
                    self.top |= 1 << b
        elif type(held) is list:
            heappush(held, position)
        else:
            self.bucket[rank] = [held, position] if held < position else [position, held]

    def pop(self) -> tuple[int, int]:
        """The lowest rank and its lowest position."""
        b = (self.top & -self.top).bit_length() - 1
        high = self.middle[b]
        a = b << 6 | (high & -high).bit_length() - 1
        word = self.low[a]
        bit = word & -word
        rank = a << 6 | bit.bit_length() - 1
        held = self.bucket[rank]
        if type(held) is list:
            position = heappop(held)
            if held:
                return rank, position
            held = position
        self.bucket[rank] = None
        self.low[a] = word = word ^ bit
        if not word:
            self.middle[b] = high = high ^ _BITS[a & 63]
            if not high:
                self.top ^= 1 << b
        return rank, held

    def merge(self, token: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(token)
        if whole is not None:
            return [whole]
        return self.merge_short(token) if len(token) <= SHORT_BYTES else self.merge_long(token)

    def merge_short(self, token: bytes) -> list[int]:
        get = self.ranks.get
        parts = [token[i : i + 1] for i in range(len(token))]
        waits = [get(token[i : i + 2], _NO_RANK) for i in range(len(token) - 1)]
        while waits and (low := min(waits)) != _NO_RANK:
            i = waits.index(low)
            parts[i] = part = parts[i] + parts.pop(i + 1)
            del waits[i]
            if i < len(waits):
                waits[i] = get(part + parts[i + 1], _NO_RANK)
            if i:
                waits[i - 1] = get(parts[i - 1] + part, _NO_RANK)
        return [self.ranks[part] for part in parts]

    def merge_long(self, token: bytes) -> list[int]:
        get, push, pop = self.ranks.get, self.push, self.pop
        n = len(token)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        waits = [-1] * n
        for i in range(n - 1):
            rank = get(token[i : i + 2])
            if rank is not None:
                waits[i] = rank
                push(rank, i)
        while self.top:
            rank, i = pop()
            if waits[i] != rank:
                continue
            gone = after[i]
            after[i] = end = after[gone]
            waits[gone] = -1
            ahead = before[i]
            if end < n:
                before[end] = i
                found = get(token[i : after[end]], -1)
                waits[i] = found
                if found >= 0:
                    push(found, i)
            else:
                waits[i] = -1
            if ahead >= 0:
                found = get(token[ahead:end], -1)
                waits[ahead] = found
                if found >= 0:
                    push(found, ahead)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[token[i : after[i]]])
            i = after[i]
        return ids


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


class Tokenizer:
    """Encodes by a rank table and a pattern that cuts texts into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.merge = Merger(ranks).merge
        self.find = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.decimal = [str(rank) for rank in range(len(self.bytes_of))]
        self.known: dict[str, tuple[int, ...]] = {}

    def _ids(self, token: str) -> tuple[int, ...]:
        ids = tuple(self.merge(token.encode()))
        if len(token) <= MOST_KNOWN_BYTES:
            if len(self.known) >= MOST_KNOWN:
                self.known.clear()
            self.known[token] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known, out = self.known, []
        extend = out.extend
        for token in self.find(text):
            ids = known.get(token)
            extend(self._ids(token) if ids is None else ids)
        return out

    def joined(self, ids: list[int]) -> str:
        return " ".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def tokenizer(lines: bytes, pattern: str) -> Tokenizer:
    """One tokenizer per worker and rank table, with what it has learnt so far, until
    the worker turns to another operator."""
    return held(("tokenizer", hash(lines), pattern), lambda: Tokenizer(read_ranks(lines), pattern))


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, keep: list[str], with_ids: bool = False) -> DataFrame:
    """The columns ``keep`` of every document with ``n_tokens``, digests of the ids
    and of the decoded bytes, and the ids themselves if asked for.

    ``rank_file`` lies with the driver; its lines, a few hundred kilobytes fixed by
    the vocabulary, go to the workers as a broadcast value."""
    spark = ship(docs.sparkSession)
    with open(rank_file, "rb") as file:
        lines = spark.sparkContext.broadcast(file.read())
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    schema = f"{kept}n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(lines.value, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                counts, ids_digests, digests, all_ids = [], [], [], []
                for text in part.column("_plain_text").to_pylist():
                    ids = own.encode(text or "")
                    counts.append(len(ids))
                    ids_digests.append(hashlib.sha256(own.joined(ids).encode()).hexdigest())
                    digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                columns = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(digests, pa.string())]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + columns, [*keep, *names])

    return docs.select(*keep, F.col("text").alias("_plain_text")).mapInArrow(encode, schema)
