"""Vectorised 64-bit hashes of byte ranges: one pass over a batch's bytes, then any range in constant time."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)
_BYTES = np.random.default_rng(20260101).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = ~SPACE  # bytes of words [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True  # bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20  # A-Z


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Ranges:
    """Hashes of ranges of one array."""

    def __init__(self, data: np.ndarray):
        """data: bytes, or 64-bit values that stand for longer things."""
        self.n = len(data)
        power, self.inverse = _powers(self.n + 1)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum((_BYTES[data] if data.dtype == np.uint8 else data) * power[: self.n], dtype=np.uint64, out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal byte strings get equal values, wherever they start."""
        return mix((self.total[ends] - self.total[starts]) * self.inverse[starts])

    def fixed(self, width: int) -> np.ndarray:
        """Of every range of that width."""
        m = max(0, self.n + 1 - width)
        return mix((self.total[width : width + m] - self.total[:m]) * self.inverse[:m])


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of the given kind of bytes, which end at row borders, and each one's row."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | border))
    ends = np.flatnonzero(before & (~inside | border))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, piece: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word. Longer data are hashed in pieces, cut at bytes of no word, so that memory stays a small
    multiple of the piece beside the result."""
    hashes, rows, a = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while a < len(data):
        b = min(len(data), a + piece)
        while b < len(data) and kind[data[b]]:
            ahead = np.flatnonzero(~kind[data[b : b + 4096]])
            b = b + int(ahead[0]) if len(ahead) else min(len(data), b + 4096)
        starts, ends, row = words(data[a:b], np.clip(offsets, a, b) - a, kind)
        hashes.append(Ranges(data[a:b]).of(starts, ends))
        rows.append(row)
        a = b
    return np.concatenate(hashes), np.concatenate(rows)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values (len - n + 1 of them; order matters)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total = total * np.uint64(BASE) + hashes[i : i + m]
    return mix(total)
