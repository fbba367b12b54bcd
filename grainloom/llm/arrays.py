"""Texts as flat numpy arrays: one pass of array code instead of a Python loop over words.

Everything here is deterministic across processes: the random tables come from a fixed seed, so a
word has the same 64-bit name on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CODES = 0x110000
#: Multiplier of the polynomial prefix hash; odd, hence invertible modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
BLOCK_CHARS = 1 << 20


@lru_cache(maxsize=1)
def code_values() -> np.ndarray:
    """A random 64-bit value for each code point."""
    return np.random.default_rng(20_240_229).integers(1, 2**63, CODES, dtype=np.int64).astype(np.uint64)


@lru_cache(maxsize=1)
def alnum_table() -> np.ndarray:
    """True where the code point is a letter or a digit."""
    flags = np.zeros(CODES, dtype=bool)
    for block in range(0, CODES, 4096):
        if block in range(0xD000, 0xE000, 4096):
            points = [p for p in range(block, block + 4096) if not 0xD800 <= p <= 0xDFFF]
        else:
            points = range(block, block + 4096)
        for p in points:
            flags[p] = chr(p).isalnum()
    return flags


@lru_cache(maxsize=1)
def space_table() -> np.ndarray:
    """True where the code point is white space for ``str.split``."""
    flags = np.zeros(CODES, dtype=bool)
    flags[[p for p in range(0x3001) if chr(p).isspace()]] = True
    return flags


@lru_cache(maxsize=1)
def space_complement() -> np.ndarray:
    return ~space_table()


_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        _powers, _inverses = (np.full(size, x, dtype=np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64)))
        _powers[0] = _inverses[0] = 1
        np.cumprod(_powers, out=_powers)
        np.cumprod(_inverses, out=_inverses)
    return _powers[:n], _inverses[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of values[k] * BASE**k for i <= k < j."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of the spans [start, end), equal for equal content wherever it stands."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters, so that arrays stay in the cache."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in a row, and where each text starts (with the end at last)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return points, offsets


def runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that stay within one text."""
    n = len(flags)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = flags.copy()
    begins[1:] &= ~flags[:-1] | edge[1:n]
    ends = flags.copy()
    ends[:-1] &= ~flags[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words as runs of code points flagged in ``table``: names, starts, ends, and per text the range of its words."""
    points, offsets = codes(texts)
    starts, ends = runs(table[points], offsets)
    sums = prefix(code_values()[points])
    return span_hash(sums, starts, ends), starts, ends, np.searchsorted(starts, offsets)
