"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes; where its mask bits are zero a chunk ends. The
hash sees the last 32 bytes only, so the ends depend on the content around them and
an insertion moves the ends near it, not those behind it. Chunks are compared by a
128-bit digest. The first chunk of a digest (smallest doc_id, then offset) stays and
all others are removed, however short: also a copy of a text of a few bytes, and a
lone chunk between new text.

Counts and minima per digest combine before the shuffle, so a chunk that a third of
all documents share is no hot spot.

Defined cases: null and empty texts have no chunks; rows without doc_id are matched
with nothing; rows that repeat doc_id and text have their chunks at the same place,
so neither is a repeat of the other; an empty table gives an empty table. Only
counts reach the driver.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.cutting import cut_spans, joined_spans
from hoptrail.llm.spool import passing, spool
from hoptrail.llm.workers import ship

MASK_BITS = 5
LEAST_CHUNK = 64
MOST_CHUNK = 256
WINDOW = 32

_GEAR = (arrays.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte; a byte shifts out after 32 more."""
    sums, step = _GEAR[data], 1
    while step < WINDOW:
        longer = sums.copy()
        longer[step:] += sums[:-step] << np.uint32(step)
        sums, step = longer, step * 2
    return sums


def chunk_ends(piece: arrays.Piece, bits: int, least: int, most: int) -> list[list[int]]:
    """Ends of the chunks of each text, counted in the piece."""
    marks = np.flatnonzero(gear_hashes(piece.data) >> np.uint32(32 - bits) == 0) + 1
    cuts = np.searchsorted(marks, piece.at, "right")
    out = []
    for i in range(len(piece)):
        begin, end = int(piece.at[i]), int(piece.at[i + 1])
        last, ends = begin, []
        for mark in marks[cuts[i] : cuts[i + 1]].tolist():
            if mark - begin < WINDOW or mark - last < least:
                continue
            while mark - last > most:
                last += most
                ends.append(last)
            if mark - last >= least or mark == end:
                ends.append(mark)
                last = mark
        while end - last > most:
            last += most
            ends.append(last)
        if end > last:
            ends.append(end)
        out.append(ends)
    return out


def chunk_digests(docs: DataFrame, bits: int, least: int, most: int) -> DataFrame:
    """One row per chunk: a digest (``d1``, ``d2``), its document, start and end."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for piece in arrays.pieces(batch.column("text")):
                ends = chunk_ends(piece, bits, least, most)
                counts = np.array([len(e) for e in ends])
                end = np.array([e for es in ends for e in es], np.int64)
                begin = piece.at[:-1].repeat(counts)
                start = np.where(np.append(True, begin[1:] != begin[:-1]), begin, np.append(0, end[:-1]))[: len(end)]
                data = memoryview(piece.data)
                found = b"".join(
                    hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist())
                )
                halves = np.frombuffer(found, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                        pa.array(ids[piece.first :][: len(piece)].repeat(counts)),
                        pa.array((start - begin).astype(np.int32)),
                        pa.array((end - begin).astype(np.int32)),
                    ],
                    ["d1", "d2", "doc_id", "first", "last"],
                )

    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(
        digest, "d1 long, d2 long, doc_id long, first int, last int"
    )


def dedup_chunks(
    docs: DataFrame,
    bits: int = MASK_BITS,
    least: int = LEAST_CHUNK,
    most: int = MOST_CHUNK,
) -> DataFrame:
    """``doc_id``, the bytes left (``kept``), their digest and counts of every document."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    chunks = chunk_digests(docs, bits, least, most)
    with passing() as held:
        heads = spool(
            chunks.groupBy("d1", "d2")
            .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first")).alias("head"))
            .where("n > 1")
            .select("d1", "d2", "head")
        )
        repeats = spool(
            chunks.join(heads, ["d1", "d2"])
            .where("doc_id <> head.doc_id or first <> head.first")
            .groupBy("doc_id")
            .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
        )
        held.append(repeats)

    def tell(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
        return joined_spans(list(zip(first.tolist(), last.tolist())))

    return cut_spans(docs, repeats, ["first", "last"], tell)
