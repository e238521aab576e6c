"""Compact binary cells for exchanges that move many numbers: one row carries thousands of them, delta coded where sorted."""

from __future__ import annotations

import numpy as np
import zstandard

LEVEL = 1


def pack(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed, so that high bytes that are alike cost nothing."""
    x = np.ascontiguousarray(x)
    return x.dtype.str.encode() + zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T).tobytes(), LEVEL)


def unpack(cell: bytes) -> np.ndarray:
    kind = np.dtype(cell[:3].decode())
    planes = np.frombuffer(zstandard.decompress(cell[3:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers as gaps."""
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(cell: bytes) -> np.ndarray:
    gaps = unpack(cell)
    return np.cumsum(gaps, dtype=gaps.dtype)


def runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Places at which a run of equal rows begins, and the end."""
    n = len(sorted_columns[0])
    new = np.zeros(n + 1, bool)
    new[[0, n]] = True
    for x in sorted_columns:
        new[1:n] |= x[1:] != x[:-1]
    return np.flatnonzero(new) if n else np.zeros(1, np.int64)
