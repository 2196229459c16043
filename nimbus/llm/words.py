"""Words of many texts at once, as numpy arrays of 64-bit hashes.

A word's hash is a polynomial over its bytes, got from prefix sums modulo
2**64 (the base is odd, so it has an inverse), then mixed. Equal words have
equal hashes; operators that need more compare the bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# Prefix sums run over pieces of this many bytes, to stay within the cache.
PIECE = 1 << 19
# Texts taken together; a longer text stands alone.
GROUP_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2 ** 64)
_rng = np.random.Generator(np.random.PCG64(20))
BYTE_VALUES = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def byte_class(pattern_bytes: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


# [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ over UTF-8 bytes.
NON_SPACE = byte_class(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = byte_class(b for b in range(256) if not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of ``data`` (sorted, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        piece = data[base:int(ends[to - 1])]
        sums = np.empty(len(piece) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[piece] * powers(_BASE, len(piece)), out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * powers(_INVERSE, len(piece) + 1)[s] + (e - s).astype(np.uint64)
        at = to
    return mix(out)


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values (64-bit)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = values[:n].copy()
    for j in range(1, k):
        h *= np.uint64(_BASE)
        h += values[j:j + n]
    return mix(h)


class Words:
    """The words of several texts: ``hash``, ``start`` and ``end`` (bytes of
    ``data``), and for text i its words ``first[i]:first[i + 1]``."""

    def __init__(self, texts: list[bytes], table: np.ndarray, lower: bool = False):
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.data = LOWER[data] if lower else data
        inside = table[self.data]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edge[::2], edge[1::2]
        self.hash = spans_hash(self.data, self.start, self.end)
        begin = np.zeros(len(texts) + 1, np.int64)
        begin[1:] = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, begin)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.n)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b-1, joined by one space."""
        raw = self.data[self.start[a]:self.end[b - 1]].tobytes()
        return b" ".join(raw[s:e] for s, e in zip((self.start[a:b] - self.start[a]).tolist(), (self.end[a:b] - self.start[a]).tolist(), strict=True))


def groups(rows: Iterable[tuple], size_of: int, limit: int = GROUP_BYTES) -> Iterator[list[tuple]]:
    """Rows in lists of about ``limit`` bytes of column ``size_of``."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[size_of])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
