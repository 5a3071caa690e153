"""Words of many texts at once as 64-bit names, by numpy on UTF-8 bytes.

A word's name is a polynomial over its bytes modulo 2**64 (from one running
sum over the buffer), mixed with its length; equal words have equal names in
every task and run. Texts are handled in buffers of about ``BUFFER`` bytes so
that the arrays stay in cache; a longer text is a buffer of its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BUFFER = 1 << 17
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Powers:
    """Powers of a base modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            k = len(self.table)
            self.table = np.concatenate([self.table, self.table * np.uint64(pow(self.base, k, 1 << 64))])
        return self.table[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def running(data: np.ndarray) -> np.ndarray:
    """Running sum whose differences name ranges of bytes, or of word names."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _DOWN.upto(len(data)), out=out[1:])
    return out


def range_names(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of ranges of the buffer behind ``sums``."""
    raw = (sums[ends] - sums[starts]) * _UP.upto(len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * _M1)


def buffers(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """(first, one past last) index of runs of texts of about BUFFER bytes."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > BUFFER:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, starts, ends, bounds) of the words of ``texts`` joined by line
    feeds: byte offsets in that buffer, and ``bounds[i]:bounds[i + 1]`` are the
    words of text ``i``."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    names = range_names(running(data), starts, ends)
    after = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(starts, after)])
    return names, starts, ends, bounds


def window_names(names: np.ndarray, width: int) -> np.ndarray:
    """Names of all runs of ``width`` words."""
    m = len(names) - width + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(width):
        out = (out ^ names[k:k + m]) * _M2 + np.uint64(k + 1)
        out ^= out >> np.uint64(29)
    return mix(out + np.uint64(width))
