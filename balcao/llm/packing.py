"""Sorted numbers as small binary values, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Sorted (or small) unsigned numbers: differences, byte planes, compressed."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    used = int(planes.any(axis=1).nonzero()[0].max(initial=0)) + 1
    body = pa.compress(planes[:used].tobytes(), codec="zstd", asbytes=True)
    return np.array([len(values), used], dtype=np.int64).tobytes() + body


def unpack(data: bytes | None) -> np.ndarray:
    if not data:
        return np.empty(0, dtype=np.uint64)
    n, used = np.frombuffer(data[:16], dtype=np.int64)
    body = pa.decompress(data[16:], int(n * used), codec="zstd", asbytes=True)
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[:used] = np.frombuffer(body, dtype=np.uint8).reshape(used, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)
