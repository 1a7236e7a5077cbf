"""Sets of word shingles as sorted 64-bit hashes, computed in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multipliers: a polynomial hash over bytes can be taken out of prefix sums
# because powers of an odd base have inverses modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 18

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, _CHUNK + (_CHUNK >> 1))
        for base, keep in ((_BASE, "_powers"), (pow(_BASE, -1, 1 << 64), "_inverses")):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[keep] = np.cumprod(table, dtype=np.uint64)
    return _powers, _inverses


def _word_hashes(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other, and the text of each.

    A-Z count as a-z. ``firsts`` are the places where non-empty texts begin.
    """
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[firsts] = True
    edge[-1] = True
    word = ~blank
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, blank[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, blank[1:]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    low = data.astype(np.uint64)
    low[(data >= 65) & (data <= 90)] += np.uint64(32)
    low += np.uint64(1)
    powers, inverses = _tables(len(data))
    low *= powers[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(low, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) * np.uint64(_BASE)))
    return hashes, np.searchsorted(firsts, starts, side="right") - 1


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of ``size`` words, sorted.

    A text of fewer words is one shingle, its whole sequence; one without words,
    null included, has none.
    """
    column = texts.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + _CHUNK, side="right")) - 1)
        yield from _chunk(data[bounds[start] : bounds[stop]], bounds[start : stop + 1] - bounds[start], size)
        start = stop


def _chunk(data: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[np.ndarray]:
    lengths = np.diff(bounds)
    filled = np.flatnonzero(lengths)
    counts = np.zeros(len(lengths), np.int64)
    hashes = np.empty(0, np.uint64)
    if len(filled):
        hashes, owner = _word_hashes(data, bounds[filled])
        counts[filled] = np.bincount(owner, minlength=len(filled))
    combined = hashes.copy()
    for j in range(1, size):
        combined[: len(hashes) - j] = combined[: len(hashes) - j] * _STEP + hashes[j:]
    combined = mix(combined)
    at = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(combined[at : at + n - size + 1])
        elif n:
            value = np.array([n], np.uint64)
            for h in hashes[at : at + n]:
                value = value * _STEP + h
            yield mix(value ^ np.uint64(_BASE))
        else:
            yield np.empty(0, np.uint64)
        at += n
