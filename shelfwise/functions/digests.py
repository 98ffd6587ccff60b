"""MD5 of all pairs of short texts, many at a time in numpy: the digest of each head followed by each tail."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np

#: Pairs handled at a time: enough to make calls cheap, and some 5 MB of arrays.
CHUNK = 1 << 17
#: Longer texts take more than one block of the digest, and go one by one.
ONE_BLOCK = 55

_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_LEFT = [np.uint32(s) for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in turns * 4]
_RIGHT = [np.uint32(32 - int(s)) for s in _LEFT]
_WORD = [(a * i + b) % 16 for a, b in ((1, 0), (5, 1), (3, 5), (7, 0)) for i in range(16)]


def _words(texts: Sequence[bytes], at: int, end: int | None = None) -> np.ndarray:
    """The 16 words of a block for each text, which begins at byte ``at``; with ``end`` the message of so many bytes ends there."""
    out = np.zeros((len(texts), 64), np.uint8)
    if texts[0]:
        out[:, at:at + len(texts[0])] = np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), -1)
    if end is not None:
        out[:, end] = 0x80
        out[:, 56:58] = [end * 8 & 255, end * 8 >> 8]
    return out.view("<u4")


def _parted(words: np.ndarray) -> tuple[list[int], list[np.ndarray | None]]:
    """For each of 16 words its value where all rows agree, else its column."""
    same = (words == words[0]).all(axis=0)
    return [int(w) if s else 0 for w, s in zip(words[0], same)], [None if s else np.ascontiguousarray(words[:, j]) for j, s in enumerate(same)]


def _md5(heads: np.ndarray, tails: tuple[list[int], list[np.ndarray | None]], shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the digest of each head's words with each tail's."""
    fixed, columns = _parted(heads)
    a, b, c, d = (np.full(shape, v, np.uint32) for v in _START)
    t, u = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_and(np.bitwise_xor(c, d, out=t), b, out=t)
            np.bitwise_xor(t, d, out=t)
        elif i < 32:
            np.bitwise_and(np.bitwise_xor(b, c, out=t), d, out=t)
            np.bitwise_xor(t, c, out=t)
        elif i < 48:
            np.bitwise_xor(np.bitwise_xor(b, c, out=t), d, out=t)
        else:
            np.bitwise_or(np.invert(d, out=t), b, out=t)
            np.bitwise_xor(t, c, out=t)
        g = _WORD[i]
        np.add(t, a, out=t)
        np.add(t, np.uint32((_ADDED[i] + fixed[g] + tails[0][g]) & 0xFFFFFFFF), out=t)
        if columns[g] is not None:
            np.add(t, columns[g][:, None], out=t)
        if tails[1][g] is not None:
            np.add(t, tails[1][g], out=t)
        np.left_shift(t, _LEFT[i], out=u)
        np.right_shift(t, _RIGHT[i], out=t)
        np.bitwise_or(t, u, out=t)
        np.add(t, b, out=a)
        a, b, c, d = d, a, b, c
    return a + np.uint32(_START[0]), b + np.uint32(_START[1])


def _by_length(texts: Sequence[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.array([len(x) for x in texts], np.int64)
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


def pairs_from(heads: Sequence[bytes], tails: Sequence[bytes], least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(head, tail, number) of the pairs whose number is at least ``least`` of the head.

    The number is that of the first 12 hexadecimal digits of the MD5 of the head and the tail put together.
    """
    least = np.asarray(least, np.int64)
    for h_len, hs in _by_length(heads):
        for t_len, ts in _by_length(tails):
            if h_len + t_len > ONE_BLOCK:
                yield from _one_by_one(heads, tails, hs, ts, least)
                continue
            head_words = _words([heads[i] for i in hs], 0)
            for part in (ts[i:i + CHUNK] for i in range(0, len(ts), CHUNK)):
                tail_words = _parted(_words([tails[i] for i in part], h_len, h_len + t_len))
                rows = max(1, CHUNK // len(part))
                for i in range(0, len(hs), rows):
                    some = hs[i:i + rows]
                    one, two = _md5(head_words[i:i + rows], tail_words, (len(some), len(part)))
                    top = one.byteswap(inplace=True)
                    at = np.flatnonzero(top >= (least[some] >> 16).astype(np.uint32)[:, None])
                    low = (two.ravel()[at] & np.uint32(0xFFFF)).astype(np.uint16).byteswap()
                    number = (top.ravel()[at].astype(np.int64) << 16) | low
                    h, t = some[at // len(part)], part[at % len(part)]
                    kept = number >= least[h]
                    yield h[kept], t[kept], number[kept]


def _one_by_one(heads, tails, hs, ts, least):
    for h in hs:
        begun = hashlib.md5(heads[h], usedforsecurity=False)
        numbers = np.empty(len(ts), np.int64)
        for i, t in enumerate(ts):
            digest = begun.copy()
            digest.update(tails[t])
            numbers[i] = int.from_bytes(digest.digest()[:6], "big")
        kept = numbers >= least[h]
        yield np.full(int(kept.sum()), h), ts[kept], numbers[kept]
