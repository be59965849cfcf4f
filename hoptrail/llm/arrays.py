"""Texts of an Arrow batch as one byte array, with vectorised words and hashes.

A batch is cut into pieces of whole texts, so the arrays stay small whatever the
batch size; a text longer than a piece makes a piece of its own. Null texts are
empty texts.

Hashes are polynomials modulo 2**64 over the bytes of a span, mixed with its
length. Prefix sums give the hash of any span in constant time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hoptrail.llm.workers import forget

PIECE_BYTES = 1 << 19

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS = {"up": np.ones(1, _U), "down": np.ones(1, _U)}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Piece:
    """``data`` holds the bytes of all texts, text i is ``data[at[i]:at[i + 1]]``."""

    first: int
    data: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1


def pieces(texts: pa.Array | pa.ChunkedArray, most: int = PIECE_BYTES) -> Iterator[Piece]:
    forget()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield Piece(first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def _powers(kind: str, n: int) -> np.ndarray:
    known = _POWERS[kind]
    if len(known) < n:
        factors = np.full(max(n, 2 * PIECE_BYTES), _U(_MULTIPLIER if kind == "up" else _INVERSE))
        factors[0] = 1
        known = np.multiply.accumulate(factors)
        if n <= 8 * PIECE_BYTES:
            _POWERS[kind] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _powers("up", len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    plain = (sums[end] - sums[start]) * _powers("down", len(sums))[start]
    return mix(plain + (end - start).astype(_U))


def runs(kinds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of equal kinds within a text; kind 0 separates.

    Gives start, end and the number of the text of each run.
    """
    n = len(kinds)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.ones(n + 1, bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:n])
    edge[at] = True
    cuts = np.flatnonzero(edge)
    start, end = cuts[:-1], cuts[1:]
    full = kinds[start] != 0
    start, end = start[full], end[full]
    counts = np.diff(np.searchsorted(start, at))
    return start, end, np.repeat(np.arange(len(at) - 1), counts)


def words(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of anything but ASCII white space."""
    return runs((~SPACE[piece.data]).view(np.uint8), piece.at)


def sequences(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of every n neighbours within one text."""
    if len(hashes) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    last = len(hashes) - n + 1
    out = hashes[:last]
    for k in range(1, n):
        out = mix(out * _U(3) + hashes[k : k + last])
    at = np.flatnonzero(text[:last] == text[n - 1 :])
    return (out if n > 1 else out.copy())[at], at


def binary_column(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())
