"""Repeated byte strings by radix passes over suffixes of limited depth.

Every string of ``length`` bytes is a suffix cut at that depth, and groups of equal
strings are what a sort of all suffixes to that depth would put side by side. The
passes go from the most significant digit on, and what is alone in its group after
a pass leaves:

1. The leading digit of a string is the part of it whose hash is least, which is at
   the same place in equal strings. Neighbouring strings mostly share it, so one row
   stands for a run of some thirty suffixes. Digits that occur once leave.
2. The second digit is all the bytes of a run. Runs with equal bytes are repeats of
   the first of them, string by string.
3. Where runs of one leading digit differ, the first run of each kind is taken apart
   into blocks of up to eight neighbours, whose digit is the bytes all of them have.
4. Where blocks of one digit differ, the first block of each kind is taken apart into
   its single strings, and these are grouped by all their bytes.

All passes count and take minima, which combine before the shuffle, so a passage
that a third of all documents share is no hot spot. Groups are compared by 64-bit
hashes: among n strings in pass 4 a wrong match is expected n * n / 2**65 times.

Defined cases: null and empty texts, and texts shorter than ``length``, lose
nothing; rows without doc_id are matched with nothing; a row that repeats doc_id and
text starts at the same place as the other one, so neither is removed for the other;
an empty table gives an empty table. Only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm import arrays
from hoptrail.llm.cutting import cut_spans, joined_spans
from hoptrail.llm.spool import only_ids, passing, spool
from hoptrail.llm.workers import ship

LENGTH = 100
DIGIT = 32

_U = np.uint64
# Kinds of spans that come together for a document.
_RUN, _RUN_HEAD, _BLOCK, _BLOCK_HEAD, _OPEN, _FIRST = range(6)
_BLOCK_BITS = 3


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def anchored_runs(piece: arrays.Piece, length: int, digit: int):
    """Runs of neighbouring strings that share their leading digit.

    The leading digit of a string is the ``digit`` bytes in it whose hash is least,
    the first of equals; equal strings have it at the same place. Gives the text,
    the place of the digit, and the first and last start of each run, all counted
    in the piece, and the prefix sums."""
    sums = arrays.prefix_sums(piece.data)
    n = len(piece.data)
    if n < length:
        return (np.zeros(0, np.int64),) * 4 + (sums,)
    at = np.arange(n - digit + 1)
    grams = arrays.span_hashes(sums, at, at + digit)
    least = sliding_least((grams & ~_U(0xFFFFFFFF)) | at.astype(_U), length - digit + 1)
    place = (least & _U(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(piece.at)
    text = np.repeat(np.arange(len(piece)), sizes)[: n - length + 1]
    whole = np.arange(n - length + 1) + length <= piece.at[text + 1]
    edge = np.ones(len(place), bool)
    edge[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(place)) - 1
    held = whole[first]
    first, last = first[held], last[held]
    return text[first], place[first], first, last, sums


def suffix_runs(docs: DataFrame, length: int, digit: int) -> DataFrame:
    """One row per run: hashes of its leading digit and of all its bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for piece in arrays.pieces(batch.column("text")):
                text, place, first, last, sums = anchored_runs(piece, length, digit)
                shape = (place - first).astype(_U) * _U(0xD6E8FEB86659FD93)
                begin = piece.at[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(arrays.span_hashes(sums, place, place + digit).view(np.int64)),
                        pa.array(arrays.mix(arrays.span_hashes(sums, first, last + length) + shape).view(np.int64)),
                        pa.array(ids[piece.first + text]),
                        pa.array((first - begin).astype(np.int32)),
                        pa.array((last - begin).astype(np.int32)),
                    ],
                    ["digit", "bytes", "doc_id", "first", "last"],
                )

    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(
        cut, "digit long, bytes long, doc_id long, first int, last int"
    )


def run_bytes(docs: DataFrame, opened: DataFrame, length: int, digit: int) -> DataFrame:
    """The bytes of the given runs, with the place of their digit. The runs of a
    document meet its text as one list, so only the texts are shuffled, and no bytes
    but those of the runs asked for leave the task."""

    def keys(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        place = (first.astype(_U) << _U(32)) + last.astype(_U)
        return arrays.mix(place + row.astype(_U) * _U(0xD6E8FEB86659FD93))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("doc_id").to_numpy(), batch.column("wanted")
            sought, counts = lists.flatten(), np.diff(lists.offsets.to_numpy())
            sought = keys(np.arange(len(ids)).repeat(counts), *(sought.field(c).to_numpy() for c in ("first", "last")))
            for piece in arrays.pieces(batch.column("text")):
                text, place, first, last, _ = anchored_runs(piece, length, digit)
                begin = piece.at[text]
                hit = np.isin(keys(piece.first + text, first - begin, last - begin), sought)
                text, place, first, last, begin = (x[hit] for x in (text, place, first, last, begin))
                data = piece.data.tobytes()
                parts = [data[a : b + length] for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[piece.first + text])]
                    + [pa.array((x - begin).astype(np.int32)) for x in (first, last, place)]
                    + [pa.array(parts, pa.binary())],
                    ["doc_id", "first", "last", "place", "part"],
                )

    wanted = opened.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("wanted"))
    texts = docs.select("doc_id", "text").where("text is not null").join(wanted, "doc_id")
    return texts.mapInArrow(cut, "doc_id long, first int, last int, place int, part binary")


def _part_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the parts of a batch and where each of them begins."""
    parts = batch.column("part").to_pylist()
    begin = np.cumsum([0, *map(len, parts)])
    return arrays.prefix_sums(np.frombuffer(b"".join(parts), np.uint8)), begin[:-1]


def blocks(parts: DataFrame, length: int) -> DataFrame:
    """The runs cut by the distance of the start from the digit. A block's digit is
    what all strings at its distances have in common."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sums, begin = _part_hashes(batch)
                first, last, place = (batch.column(c).to_numpy().astype(np.int64) for c in ("first", "last", "place"))
                low, high = (place - last) >> _BLOCK_BITS, (place - first) >> _BLOCK_BITS
                counts = high - low + 1
                run = np.arange(len(counts)).repeat(counts)
                block = np.arange(len(run)) - (np.cumsum(counts) - counts)[run] + low[run]
                most = place[run] - (block << _BLOCK_BITS)
                least = most - (1 << _BLOCK_BITS) + 1
                lo, hi = np.maximum(least, first[run]), np.minimum(most, last[run])
                shift = begin[run] - first[run]
                shape = (block * 64 + (most - lo) * 8 + (most - hi)).astype(_U) * _U(0xD6E8FEB86659FD93)
                core = arrays.span_hashes(sums, shift + most, shift + least + length)
                core = arrays.mix(core + block.astype(_U) * _U(0xFF51AFD7ED558CCD))
                held = arrays.mix(arrays.span_hashes(sums, shift + lo, shift + hi + length) + shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)),
                        pa.array(held.view(np.int64)),
                        pa.array(batch.column("doc_id").to_numpy()[run]),
                        *(pa.array(x.astype(np.int32)) for x in (lo, hi, first[run])),
                    ],
                    ["digit", "bytes", "doc_id", "first", "last", "run"],
                )

    return parts.mapInArrow(cut, "digit long, bytes long, doc_id long, first int, last int, run int")


def single_strings(parts: DataFrame, opened: DataFrame, length: int) -> DataFrame:
    """Hash and start of every string of the given blocks of runs."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sums, begin = _part_hashes(batch)
                run, lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("run", "low", "high"))
                counts = hi - lo + 1
                block = np.arange(len(counts)).repeat(counts)
                starts = np.arange(len(block)) - (np.cumsum(counts) - counts)[block] + lo[block]
                place = starts - run[block] + begin[block]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(arrays.span_hashes(sums, place, place + length).view(np.int64)),
                        pa.array(batch.column("doc_id").to_numpy()[block]),
                        pa.array(starts.astype(np.int32)),
                    ],
                    ["string", "doc_id", "start"],
                )

    wanted = opened.selectExpr("doc_id", "run", "first as low", "last as high")
    held = parts.selectExpr("doc_id", "first as run", "part").join(wanted, ["doc_id", "run"])
    return held.select("doc_id", "run", "low", "high", "part").mapInArrow(take, "string long, doc_id long, start int")


def _repeated_digits(rows: DataFrame) -> DataFrame:
    """The rows whose digit is not alone."""
    digits = rows.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit")
    return spool(only_ids(rows, spool(digits), "digit"))


def _heads(rows: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each kind of bytes, and those whose digit has several kinds."""
    heads = spool(
        rows.groupBy("digit", "bytes")
        .agg(F.min(F.struct("doc_id", "first", "last", *more)).alias("head"))
        .select("digit", "head.*")
    )
    mixed = heads.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit")
    return heads, spool(heads.join(mixed, "digit").drop("digit"))


def repeated_starts(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """Per document with any repeated digit: ``spans``, from which
    :func:`removed_spans` tells the starts of strings that also start earlier."""
    runs = _repeated_digits(suffix_runs(docs, length, digit))
    run_heads, opened_runs = _heads(runs)
    parts = spool(run_bytes(docs, opened_runs, length, digit))
    cut = _repeated_digits(spool(blocks(parts, length)))
    block_heads, opened = _heads(cut, "run")
    firsts = (
        single_strings(parts, opened, length)
        .groupBy("string")
        .agg(F.min(F.struct("doc_id", "start")).alias("first"))
        .select("first.doc_id", F.col("first.start").alias("first"), F.col("first.start").alias("last"))
    )
    kinds = (runs, run_heads, cut, block_heads, opened, firsts)
    union = None
    for kind, rows in enumerate(kinds):
        tagged = rows.select("doc_id", F.lit(kind).alias("kind"), "first", "last")
        union = tagged if union is None else union.union(tagged)
    return union.groupBy("doc_id").agg(F.collect_list(F.struct("kind", "first", "last")).alias("spans"))


def removed_spans(kind: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes of one document."""
    whole = []
    for all_kind, head_kind in ((_RUN, _RUN_HEAD), (_BLOCK, _BLOCK_HEAD)):
        heads, own = set(first[kind == head_kind].tolist()), kind == all_kind
        whole += [(a, b) for a, b in zip(first[own].tolist(), last[own].tolist()) if a not in heads]
    firsts = np.unique(first[kind == _FIRST])
    opened = sorted(set(zip(first[kind == _OPEN].tolist(), last[kind == _OPEN].tolist())))
    if opened:
        starts = np.concatenate([np.arange(a, b + 1) for a, b in opened])
        starts = np.setdiff1d(starts, firsts, assume_unique=False)
        if len(starts):
            gap = np.flatnonzero(np.diff(starts) > 1)
            whole += zip(starts[np.append(0, gap + 1)].tolist(), starts[np.append(gap, len(starts) - 1)].tolist())
    return joined_spans([(a, b + length) for a, b in whole])


def remove_repeats(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """``doc_id``, the bytes left (``kept``), their digest and counts of every document."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    with passing() as held:
        found = spool(repeated_starts(docs, length, digit))
        held.append(found)
    return cut_spans(docs, found, ["kind", "first", "last"], lambda *spans: removed_spans(*spans, length))
