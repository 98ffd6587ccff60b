"""Whole Arrow columns of text as flat numpy arrays of words and word hashes.

A word is a run of bytes other than ``0x20`` and ``0x09-0x0D``; in UTF-8 no other character holds
such a byte. Texts are handled in blocks of about ``BLOCK_BYTES`` so the arrays stay small; a
longer text is a block of its own. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Block:
    """Some texts: ``data`` holds their bytes, text i is ``data[offsets[i]:offsets[i+1]]``.

    Words ``first[i]`` to ``first[i+1]`` belong to text i and lie at ``data[start:end]``.
    """

    row: int  # of the first text in its column
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def blocks(column: pa.Array, lower: bool = False) -> Iterator[Block]:
    """The column's texts in blocks, in order; ``lower`` maps A-Z to a-z."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield _block(row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row], lower)
        row = stop


def _block(row: int, data: np.ndarray, offsets: np.ndarray, lower: bool) -> Block:
    if lower:
        data = _LOWER[data]
    inside = ~_SEPARATOR[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]  # a text's first byte begins a word whatever stands before it
    heads = edges[edges < len(data)]
    begins[heads] = inside[heads]
    tails = edges[edges > 0] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Block(row, data, offsets, start, end, np.searchsorted(start, offsets))


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``size`` or more of each."""
    return _powers(1 << max(16, int(size).bit_length()))


def forget() -> None:
    """Drop the powers kept; they are soon made again."""
    _powers.cache_clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``; equal content and length give equal hashes."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(block: Block) -> np.ndarray:
    return span_hashes(block.data, block.start, block.end)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each ``length`` consecutive words; run i starts at word i."""
    at = np.arange(max(0, len(hashes) - length + 1))
    return span_hashes(hashes, at, at + length)


def runs_inside(block: Block, length: int) -> np.ndarray:
    """Whether the run of ``length`` words from each word lies in one text."""
    last = np.repeat(block.first[1:], np.diff(block.first))
    return np.arange(len(block.start)) + length <= last
