"""Compact encodings of sorted integers and of flags, for exchanges between partitions."""

from __future__ import annotations

import numpy as np


def rice_parameter(mean_gap: float) -> int:
    """Bits of the fixed part of a Golomb-Rice code for gaps of that mean."""
    return max(0, int(np.floor(np.log2(max(1.0, mean_gap * np.log(2))))))


def golomb_encode(values: np.ndarray, k: int) -> bytes:
    """Sorted distinct uint64 values as Golomb-Rice coded gaps.

    A gap g is written as g >> k in unary and its low k bits. The unary parts and the
    fixed parts stand apart, so both decode without a loop.
    """
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    high = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(high + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    fixed = (gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes() + np.packbits(fixed.astype(np.uint8).ravel()).tobytes()


def golomb_decode(data: bytes, n: int, k: int) -> np.ndarray:
    """The n values of `golomb_encode`."""
    if not n:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    fixed_bytes = (n * k + 7) // 8
    ends = np.flatnonzero(np.unpackbits(raw[: len(raw) - fixed_bytes]))[:n]
    high = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(raw[len(raw) - fixed_bytes :])[: n * k].reshape(n, k).astype(np.uint64)
    low = (bits << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((high.astype(np.uint64) << np.uint64(k)) + low, dtype=np.uint64)


def pack(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
