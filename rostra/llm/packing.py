"""Integer arrays as bytes: deltas or values, one plane per byte, so that zero bytes compress away."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers; the first byte says how many bytes each has."""
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    n = (len(data) - 1) // width
    planes = np.zeros((n, 8), dtype=np.uint8)
    planes[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, n).T
    return planes.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    values = values.astype(np.uint64)
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)
