"""Words of many texts at once: positions and 64-bit hashes by numpy.

Texts are bytes in one buffer. A word's hash is a polynomial over its bytes
modulo 2**64, taken from prefix sums, then mixed with its length; equal words
have equal hashes, and operators that need certainty compare bytes after it."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Words between ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False


class _Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << max(16, (n - 1).bit_length())
            out = []
            for base in (_BASE, _INVERSE):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                out.append(np.multiply.accumulate(a))
            self.up, self.down = out
        return self.up, self.down


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(low: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base**i, one entry more than bytes."""
    up, _ = _POWERS.upto(len(low) + 1)
    out = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(low)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end)."""
    _, down = _POWERS.upto(len(sums))
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


class Words:
    """Words of the rows ``offsets`` of ``buf``: ``start`` and ``end`` bytes,
    ``row`` of each word, ``first`` word of each row (one entry more), ``hash``."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray):
        self.low = LOWER[buf]
        n = len(offsets) - 1
        inside = np.zeros(len(buf) + 2, bool)
        inside[1:-1] = alphabet[self.low]
        begins = inside[1:-1] & ~inside[:-2]
        finishes = inside[1:-1] & ~inside[2:]
        edges = offsets[:-1][np.diff(offsets) > 0]  # a word never crosses rows
        begins[edges] = inside[1:-1][edges]
        last = offsets[1:][np.diff(offsets) > 0] - 1
        finishes[last] = inside[1:-1][last]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(finishes) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.row, np.arange(n + 1))
        self.count = np.diff(self.first)
        self.hash = span_hashes(prefix_sums(self.low), self.start, self.end)

    def text(self, k: int) -> bytes:
        return self.low[self.start[k]:self.end[k]].tobytes()


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair."""
    return mix(left * np.uint64(0xA24BAED4963EE407) + right)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive entries (rows not heeded)."""
    n = max(0, len(hashes) - length + 1)
    out = hashes[:n].copy()
    for k in range(1, length):
        out = join_hashes(out, hashes[k:k + n])
    return out
