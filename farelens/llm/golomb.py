"""Golomb-Rice coding of sorted distinct numbers, in whole arrays.

The gaps between neighbours are split into a quotient by ``2 ** k``, in unary, and ``k``
remainder bits; ``k`` follows from the mean gap.  For evenly spread fingerprints this takes
about 1.5 bits more than the logarithm of the mean gap.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBI")  # count, k, bytes of the unary part


def encode(values: np.ndarray) -> bytes:
    """Code a sorted array of distinct unsigned 64-bit numbers."""
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0)
    values = values.astype(np.uint64)
    gaps = np.diff(values, prepend=values[:1]) - np.uint64(1)
    gaps[0] = values[0]
    mean = int(values[-1]) // n
    k = max(0, (mean * 69 // 100).bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    head = np.packbits(unary).tobytes()
    bits = np.unpackbits(gaps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1,
                         bitorder="little")[:, :k]
    return _HEAD.pack(n, k, len(head)) + head + np.packbits(bits).tobytes()


def decode(blob: bytes) -> np.ndarray:
    """The array that ``encode`` was given."""
    n, k, size = _HEAD.unpack_from(blob)
    if n == 0:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(blob, np.uint8, offset=_HEAD.size)
    ends = np.flatnonzero(np.unpackbits(data[:size]) == 0)[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    rest = np.zeros((n, 64), np.uint8)
    rest[:, :k] = np.unpackbits(data[size:], count=n * k).reshape(n, k)
    gaps = np.packbits(rest, axis=1, bitorder="little").view("<u8").ravel()
    gaps = gaps + (quotients.astype(np.uint64) << np.uint64(k))
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64)


def by_owner(values: np.ndarray, owners: int, bits: int) -> list[tuple[int, np.ndarray]]:
    """Cut sorted numbers below ``2 ** bits`` into the equal ranges of their owners.

    The values of a range count from its start.
    """
    starts = [(o << bits) // owners for o in range(owners)]
    cuts = [*np.searchsorted(values, np.array(starts, np.uint64)), len(values)]
    return [(o, values[a:b] - np.uint64(starts[o]))
            for o, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def range_start(owner: int, owners: int, bits: int) -> int:
    return (owner << bits) // owners


def pack(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(bool)).tobytes()


def unpack(bitmap: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n).astype(bool)
