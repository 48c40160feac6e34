"""Compressed blobs of arrays for exchanges that would cost too much as rows."""

from __future__ import annotations

import pickle

import numpy as np
import zstandard


def packed(*values) -> bytes:
    return zstandard.compress(pickle.dumps(values, protocol=5), 1)


def unpacked(blob: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(blob))


def small(values: np.ndarray) -> tuple[int, np.ndarray]:
    """The least value, and the differences from it in as few bytes as hold them."""
    least = int(values.min()) if len(values) else 0
    rest = values.astype(np.int64) - least if len(values) else np.zeros(0, np.int64)
    return least, rest.astype(np.min_scalar_type(int(rest.max()) if len(rest) else 0)) if (rest >= 0).all() else rest


def large(packed: tuple[int, np.ndarray]) -> np.ndarray:
    return packed[1].astype(np.int64) + packed[0]


def planed(values: np.ndarray) -> tuple[int, int, bytes]:
    """Integers from 0 on, in as few bytes as hold the largest. Bytes stand by place: the higher ones are mostly 0."""
    values = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    return len(values), values.itemsize, np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def planes(packed: tuple[int, int, bytes]) -> np.ndarray:
    n, width, data = packed
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.int64)


def rising(values: np.ndarray) -> tuple[int, int, bytes, int]:
    """Sorted unsigned values as the first and the steps, in as few bytes as hold them. The steps' bytes stand by place,
    as those of hashes are random but for the highest."""
    steps = np.diff(values)
    steps = steps.astype(np.min_scalar_type(int(steps.max()) if len(steps) else 0))
    return int(values[0]), len(steps), np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), steps.itemsize).T).tobytes(), steps.itemsize


def risen(packed: tuple[int, int, bytes, int]) -> np.ndarray:
    first, n, planes, width = packed
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel() if n else np.zeros(0, np.uint8)
    return np.uint64(first) + np.concatenate((np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)))


def ranges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Borders in sorted 64-bit hashes of equal ranges of their values."""
    return np.searchsorted(hashes, [np.uint64(b * 2**64 // buckets) for b in range(buckets)] + [np.uint64(2**64 - 1)]) if buckets else np.zeros(1, np.int64)
