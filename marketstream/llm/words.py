"""Words of many texts at once: spans and 64-bit hashes from the bytes of an Arrow string array.

A kind of word is a set of bytes; a word is a longest run of such bytes within one text. Words are hashed by a
polynomial over their bytes, A-Z taken as a-z, so that all words come out of a few passes over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Texts are handled in pieces of about so many bytes, which bounds the memory of a task.
PIECE_BYTES = 2 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    kind = np.zeros(256, dtype=bool)
    for first, last in ranges:
        kind[first : last + 1] = True
    return kind


ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
NOT_SPACE = ~byte_set((0x09, 0x0D), (0x20, 0x20))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values that spreads every bit."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


GOLDEN = np.uint64(0x9E3779B97F4A7C15)
VALUE_OF_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * GOLDEN)[LOWER]
BASE = 0xD6E8FEB86659FD93
BASE_INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    return powers(base, 1 << max(16, int(n - 1).bit_length()))[:n]


class Words(NamedTuple):
    hashes: np.ndarray  #: of all words, text after text
    first: np.ndarray  #: for each text, and after the last, the index of its first word
    starts: np.ndarray  #: byte position of each word in ``data``
    ends: np.ndarray
    data: np.ndarray  #: the bytes of all texts
    offsets: np.ndarray  #: for each text, and after the last, its first byte


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins; null is empty."""
    column = column.cast(pa.large_string()).fill_null("") if len(column) else pa.array([], pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, place, values = column.buffers()
    offsets = np.frombuffer(place, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of members that lie within one text."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, stops = member.copy(), member.copy()
    begins[1:] &= ~member[:-1]
    stops[:-1] &= ~member[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    begins[edge] = member[edge]
    stops[edge - 1] = member[edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    starts, ends = runs(kind[data], offsets)
    return Words(span_hashes(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, A-Z taken as a-z."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUE_OF_BYTE[data] * _powers(BASE, len(data)), out=total[1:])
    inner = (total[ends] - total[starts]) * _powers(BASE_INVERSE, len(data) + 1)[starts]
    return mix(inner + (ends - starts).astype(np.uint64) * GOLDEN)


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of consecutive words, given the words' own hashes."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(BASE, len(hashes)), out=total[1:])
    inner = (total[ends] - total[starts]) * _powers(BASE_INVERSE, len(hashes) + 1)[starts]
    return mix(inner + (ends - starts).astype(np.uint64) * GOLDEN)


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def each_piece(column: pa.Array, kind: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """The words of a string column, piece by piece: first text, text after the last, words."""
    data, offsets = texts_of(column)
    for a, b in pieces(offsets, size):
        part = offsets[a : b + 1]
        yield a, b, words(data[part[0] : part[-1]], part - part[0], kind)
