"""Byte-level text work on Arrow columns in numpy: no Python object per document or word.

A text column of an Arrow batch is one run of UTF-8 bytes with offsets.  ``pieces`` cuts it, between
documents, into runs of bounded size; everything else works on one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

#: Bytes and documents worked on at once; one longer document is one piece of its own.
PIECE_BYTES, PIECE_ROWS = 512 << 10, 4000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[i] the sum of code(byte k) * base**k for k < i, modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    power, _ = power_tables(len(data) + 1)
    np.cumsum(_CODE[data] * power[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal bytes have equal hashes wherever they stand."""
    _, inverse = power_tables(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Piece:
    """Some whole documents: rows first_row and on of a batch, their bytes end to end."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words; a word never crosses documents."""
        word = ~_SPACE[self.data]
        starts, ends = word.copy(), word.copy()
        starts[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = self.offsets[self.offsets < len(word)]
        starts[inner] = word[inner]
        inner = inner[inner > 0]
        ends[inner - 1] = word[inner - 1]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    @cached_property
    def word_bounds(self) -> np.ndarray:
        """Word numbers at which the documents start, with the total at the end."""
        return np.searchsorted(self.words[0], self.offsets)

    def word_hashes(self) -> np.ndarray:
        return span_hashes(prefix_hashes(self.data), *self.words)


def lowered(piece: Piece) -> Piece:
    """A-Z in lower case; other bytes as they are."""
    return Piece(piece.first_row, _LOWER[piece.data], piece.offsets)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and len + 1 offsets; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    if not len(column):
        return
    data, offsets = text_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = min(max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1), first + PIECE_ROWS)
        yield Piece(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def repeat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges start .. start + length end to end, as one index array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
